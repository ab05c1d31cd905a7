"""DartMinHash signatures of weighted shingle sets, with numpy.

Darts fall on the plane of weight and rank above each element as a Poisson process of density 1, the same for every
document: a hash of element, unit of weight and band of ranks gives the number of darts in that cell, and a hash of each
dart its place and one of k coordinates. A document keeps the darts below its elements' weights and, for each
coordinate, the earliest. Two documents agree in a coordinate with the probability of their weighted Jaccard
similarity. Bands of ranks double in width and are opened only until all coordinates are hit, which takes about
k * ln(k) darts whatever the size of the document.
"""

from __future__ import annotations

import functools

import numpy as np

from tidemill.llm.codes import mix, pack, wordlike
from tidemill.llm.common import PIECE, pieces_of

FIRST = 1 / 2
_A, _B, _C, _D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word (run of letters, numbers and marks, in lower case), and where each text's words start.

    Very long texts are read in parts: besides the hashes a part takes memory, not the text.
    """
    if all(len(t) <= PIECE for t in texts):
        return hashed(texts)
    parts = [[hashed([p])[0] for p in pieces_of(t)] for t in texts]
    return np.concatenate([h for own in parts for h in own]), np.concatenate([[0], np.cumsum([sum(map(len, own)) for own in parts])])


def hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    codes, ends = pack([t.lower() for t in texts])
    inside = wordlike()[codes]
    inside[ends] = False
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = np.flatnonzero(first)
    starts = np.concatenate([[0], np.searchsorted(at, ends)])
    if not len(at):
        return np.zeros(0, np.uint64), starts
    letters = np.flatnonzero(inside)
    begin = np.searchsorted(letters, at)
    place = letters - np.repeat(at, np.diff(np.append(begin, len(letters))))
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(int(place.max()), 0x100000001B3, np.uint64)]))
        sums = np.add.reduceat(mix(codes[letters].astype(np.uint64) + _A) * powers[place], begin)
    return mix(sums), starts


def shingles(texts: list[str], width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of all texts: text number, hash, how often. Sorted by text.

    A text of fewer words than `width` has one shingle of all its words; a text without words one of its characters.
    """
    hashes, starts = words(texts)
    n = np.diff(starts)
    with np.errstate(over="ignore"):
        count = np.maximum(n - width + 1, 0)
        text = np.repeat(np.arange(len(texts)), count)
        at = np.repeat(starts[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        whole = np.zeros(len(at), np.uint64)
        for i in range(width):
            whole = mix(whole * _B + hashes[at + i])
        short_text, short = [], []
        for t in np.flatnonzero(count == 0):
            x = np.uint64(n[t] + 1)
            for h in hashes[starts[t] : starts[t + 1]] if n[t] else np.frombuffer(("\0" + texts[t]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64):
                x = mix(np.atleast_1d(x * _B + h))[0]
            short_text.append(t)
            short.append(x)
    text = np.concatenate([text, np.array(short_text, np.int64)])
    whole = np.concatenate([whole, np.array(short, np.uint64)])
    order = np.lexsort((whole, text))
    text, whole = text[order], whole[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(new)
    return text[first], whole[first], np.diff(np.append(first, len(text)))


def occurrences(text: np.ndarray, shingle: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each occurrence: the Jaccard similarity of these sets is the weighted one of the shingles. Sorted by text."""
    at = np.repeat(np.arange(len(text)), often)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(often) - often, often)
    with np.errstate(over="ignore"):
        return text[at], mix(shingle[at] + _C * nth.astype(np.uint64))


@functools.lru_cache(maxsize=64)
def poisson(mean: float) -> np.ndarray:
    """Its distribution function at 0, 1, 2, ..."""
    top = int(mean + 12 * np.sqrt(mean) + 20)
    i = np.arange(1, top)
    return np.cumsum(np.exp(np.concatenate([[-mean], -mean + i * np.log(mean) - np.cumsum(np.log(i))])))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers from 0 up to 1."""
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


class Cells:
    """The elements of all documents, cut into units of weight; `part` is how much of its unit the last cell holds."""

    def __init__(self, owner: np.ndarray, elements: np.ndarray, weights: np.ndarray):
        cells = np.ceil(weights).astype(np.int64)
        if (cells == 1).all():
            self.owner, self.seed, self.part = owner, mix(elements), weights
        else:
            which = np.repeat(np.arange(len(elements)), cells)
            cell = np.arange(len(which)) - np.repeat(np.cumsum(cells) - cells, cells)
            self.owner, self.part = owner[which], np.minimum(weights[which] - cell, 1.0)
            with np.errstate(over="ignore"):
                self.seed = mix(elements[which] + _C * cell.astype(np.uint64))
        self.whole = bool((self.part == 1).all())

    def throw(self, some: np.ndarray, level: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The darts of one band of ranks that hit some cells: owner * k + coordinate, rank, name.

        A dart's name gives its coordinate (top 24 bits) and its rank (the other 40).
        """
        low, wide = (0.0, FIRST) if level == 0 else (FIRST * 2 ** (level - 1),) * 2
        with np.errstate(over="ignore"):
            base = mix(self.seed[some] + _D * np.uint64(level + 1))
            number = np.searchsorted(poisson(wide), unit(base), side="right")
            dart = np.repeat(np.arange(len(base)), number)
            nth = np.arange(len(dart)) - np.repeat(np.cumsum(number) - number, number)
            name = mix(base[dart] + _A * (nth + 1).astype(np.uint64))
            dart = some[dart]
            if not self.whole:
                hit = unit(mix(name ^ _B)) < self.part[dart]
                dart, name = dart[hit], name[hit]
            rank = low + wide / (1 << 40) * (name & np.uint64((1 << 40) - 1)).astype(np.float64)
            slot = self.owner[dart] * k + ((name >> np.uint64(40)) * np.uint64(k) >> np.uint64(24)).astype(np.int64)
        return slot, rank, name


def signatures(owner: np.ndarray, elements: np.ndarray, weights: np.ndarray, n: int, k: int) -> np.ndarray:
    """n rows of k dart names. owner is sorted, and each of 0 .. n - 1 owns an element of positive weight."""
    total = np.bincount(owner, weights=weights, minlength=n)
    need = np.ceil(np.log2(np.maximum(k * (np.log(k) + 2) / np.maximum(total, 1e-9) / FIRST, 1))).astype(np.int64)
    out, best = np.zeros(n * k, np.uint64), np.full(n * k, np.inf)
    cells, level, thrown = Cells(owner, elements, weights), 0, np.full(n, -1)
    while True:
        for at in range(level + 1):  # a document that needs a later band has had all before it, but for those found late
            open_ = (need >= at) & (thrown == at - 1)
            some = np.flatnonzero(open_[cells.owner])
            if not len(some):
                continue
            thrown[open_] = at
            slot, rank, name = cells.throw(some, at, k)
            np.minimum.at(best, slot, rank)
            first = rank == best[slot]
            out[slot[first]] = name[first]
        level += 1
        if level > need.max():
            missing = np.isinf(best).reshape(n, k).any(axis=1)
            if not missing.any():
                return out.reshape(n, k)
            need[missing] = thrown[missing] + 1
            level = int(need.max())


def banded(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of so many coordinates; a key tells the band's number too."""
    n, k = signature.shape
    parts = signature.reshape(n, k // rows, rows)
    key = np.broadcast_to(np.arange(1, k // rows + 1, dtype=np.uint64), (n, k // rows)).copy()
    with np.errstate(over="ignore"):
        for i in range(rows):
            key = mix(key * _B + parts[:, :, i])
    return key.view(np.int64)
