"""Hashed character n-grams of words, counted for many texts at once with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tidemill.llm.codes import mix, pack, wordlike


class Bags:
    """The words of some texts and the buckets of their n-grams.

    A word is a run of letters, numbers and marks, in lower case. Its n-grams see a boundary on either side.
    `starts[d]:starts[d + 1]` are the words of text d.
    """

    def __init__(self, texts: list[str], orders: tuple[int, ...], bits: int):
        # an empty text first, so that the first word too has a boundary before it
        codes, ends = pack(["", *(t.lower() for t in texts)])
        ends = ends[1:]
        self.orders, self.bits = orders, bits
        inside = wordlike()[codes]
        inside[ends] = False
        inside[0] = False
        self.codes = np.where(inside, codes, 1).astype(np.uint64)
        self.inside = inside
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        self.first = np.flatnonzero(first)
        self.word_of = np.cumsum(first) - 1
        self.words = len(self.first)
        self.starts = np.concatenate([[0], np.searchsorted(self.first, ends)])

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(bucket, word) arrays, one pair for each order."""
        codes, n = self.codes, len(self.codes)
        with np.errstate(over="ignore"):
            rolled, length = codes * np.uint64(0x9E3779B97F4A7C15), 1
            whole = np.ones(n, bool)
            for order in range(2, max(self.orders) + 1):
                if n < order:
                    return
                rolled = rolled[: n - order + 1] * np.uint64(0x100000001B3) + codes[order - 1 :]
                if order > 2:
                    whole = whole[: n - order + 1] & self.inside[order - 2 : n - 1]
                length = order
                if order in self.orders and order > 2:
                    at = np.flatnonzero(whole)
                    bucket = mix(rolled[at] + np.uint64(length)) >> np.uint64(64 - self.bits)
                    yield bucket.astype(np.int64), self.word_of[at + 1]

    def sums(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word, the sum of its n-grams' values (a column for each of values' columns) and their number."""
        wide = values.reshape(len(values), -1)
        total, count = np.zeros((self.words, wide.shape[1])), np.zeros(self.words)
        for bucket, word in self.grams():
            count += np.bincount(word, minlength=self.words)
            for k in range(wide.shape[1]):
                total[:, k] += np.bincount(word, weights=wide[bucket, k], minlength=self.words)
        return total, count


def by_text(x: np.ndarray, starts: np.ndarray, how: np.ufunc, empty: float) -> np.ndarray:
    """`how` over each text's words; `empty` for a text without words."""
    n = len(starts) - 1
    out = np.full((n, *x.shape[1:]), empty, float)
    full = np.flatnonzero(starts[1:] > starts[:-1])
    if len(full):
        out[full] = how.reduceat(x, starts[:-1][full], axis=0)
    return out


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


class Embedder:
    """Embeddings of buckets, averaged over a bag, and a linear softmax on top; both learn together by Adagrad."""

    def __init__(self, buckets: int, classes: int, dims: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.vectors = (rng.random((buckets, dims), np.float32) - 0.5) / dims
        self.weights = (rng.random((dims, classes)) - 0.5).astype(np.float32)
        self.bias = np.zeros(classes, np.float32)
        self.seen = np.full(buckets, 1e-3, np.float32)
        self.seen_w = 1e-3

    def logits(self, bucket: np.ndarray, part: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mean = np.add.reduceat(self.vectors[bucket] * part[:, None], starts[:-1], axis=0)
        return mean @ self.weights + self.bias, mean

    def step(self, bucket: np.ndarray, part: np.ndarray, starts: np.ndarray, wanted: np.ndarray, rate: float) -> None:
        """One step on bags: bag i has buckets bucket[starts[i]:starts[i+1]] with shares `part` (sum 1).

        wanted: for each bag and class the weight of examples of that class.
        """
        z, mean = self.logits(bucket, part, starts)
        weight = wanted.sum(axis=1, keepdims=True)
        error = ((softmax(z) * weight - wanted) / max(weight.sum(), 1e-9)).astype(np.float32) * len(wanted)
        back = error @ self.weights.T
        own = np.repeat(back, np.diff(starts), axis=0) * part[:, None]
        rows, where = np.unique(bucket, return_inverse=True)
        grad = np.zeros((len(rows), own.shape[1]), np.float32)
        for k in range(own.shape[1]):
            grad[:, k] = np.bincount(where, weights=own[:, k], minlength=len(rows))
        self.seen[rows] += (grad**2).mean(axis=1)
        self.vectors[rows] -= rate * grad / np.sqrt(self.seen[rows])[:, None]
        slope = mean.T @ error / len(wanted)
        self.seen_w += float((slope**2).mean())
        self.weights -= rate * slope / np.sqrt(self.seen_w)
        self.bias -= rate * error.mean(axis=0)

    def table(self) -> np.ndarray:
        """What each bucket adds to the logits: scoring needs only this and the bias."""
        return (self.vectors @ self.weights).astype(np.float64)
