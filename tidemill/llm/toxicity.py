"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's vector is the mean of its character n-grams' vectors, so a misspelling that was never seen shares most of
them with the word it stands for. A document's vector is the mean over its TOP most toxic distinct words, the words that
the softmax itself puts highest; the mean over all words of a long text would drown a few insults among thousands of clean
words, and a single word says too little. One linear softmax reads that mean. Three steps fit the model on the driver, on
a bounded sample:

1. every distinct word learns how often documents that hold it are toxic (embeddings and softmax together);
2. for some rounds documents learn: the mean of their top words, toxic or not as the document is, moves both again;
3. the softmax's weights and bias are scaled to give probabilities on a quarter of the sample, kept apart.

Defined results: a null or empty text, or one without words, gets the score of the lowest logit, near 0. A text of fewer
distinct words has the mean of those. Equal texts have equal scores; which of equally toxic words counts makes no
difference. Null labels and labels of no document are ignored; repeated labels of a document count as their maximum.
Without labels of both kinds every score is the share of toxic labels (0 if there are none). Other columns of the input
stay unless their names are those of the result (score and predicted, in any case of letters), which are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import PIECE, held_out, in_arrow, pieces_of, release, slices
from tidemill.llm.samples import texts_of
from tidemill.llm.subword import Bags, Embedder

THRESHOLD = 0.3
WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Parameters:
    #: The bound of the sample: about so many documents of either label, none longer than so many code points.
    per_class: int = 2000
    most_chars: int = 50_000
    orders: tuple[int, ...] = (3, 4, 5, 6)
    bits: int = 17
    dims: int = 8
    #: Passes over the words and rounds over the documents; small samples get more, for so many steps at least.
    epochs: int = 3
    rounds: int = 6
    steps: int = 40
    rate: float = 0.3
    prior: float = 1.0
    #: Distinct words of a document that are averaged.
    top: int = 3


@dataclass
class Model:
    table: np.ndarray  # of each bucket, toxic minus clean logit
    bias: float
    orders: tuple[int, ...]
    bits: int
    top: int

    def highest(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The logits of each text's top distinct words, and which text they are of."""
        bags = Bags(texts, self.orders, self.bits)
        total, count = bags.sums(self.table)
        return tops(total[:, 0] / np.maximum(count, 1), np.repeat(np.arange(len(texts)), np.diff(bags.starts)), self.top)

    def raw(self, texts: list[str]) -> np.ndarray:
        """The logit of each text: very long ones are read in parts, whose top words are those of the whole."""
        if any(len(t) > PIECE for t in texts):
            parts = [[self.highest([p])[0] for p in pieces_of(t)] for t in texts]
            z, of = tops(np.concatenate([x for own in parts for x in own]), np.repeat(np.arange(len(texts)), [sum(map(len, own)) for own in parts]), self.top)
        else:
            z, of = self.highest(texts)
        n = np.bincount(of, minlength=len(texts))
        return np.where(n > 0, np.bincount(of, weights=z, minlength=len(texts)) / np.maximum(n, 1) + self.bias, min(self.bias, -30.0))

    def score(self, texts: list[str]) -> np.ndarray:
        z = np.clip(self.raw(texts), -30, 30)
        return np.round(1 / (1 + np.exp(-z)), 6)


def tops(z: np.ndarray, of: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The `top` highest distinct values of each group, and their groups. A word has one value wherever it stands."""
    z = np.round(z, 9)
    order = np.lexsort((-z, of))
    z, of = z[order], of[order]
    new = np.ones(len(z), bool)
    new[1:] = (of[1:] != of[:-1]) | (z[1:] != z[:-1])
    z, of = z[new], of[new]
    first = np.searchsorted(of, of)
    kept = np.arange(len(z)) - first < top
    return z[kept], of[kept]


def curve(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a weighted logistic curve (damped Newton steps; the prior keeps it finite)."""
    center, spread = float(np.median(z)), float(z.std()) or 1.0
    x = np.stack([(z - center) / spread, np.ones_like(z)], axis=1)
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + np.eye(2) * 0.01
        step = np.linalg.solve(hess, x.T @ (w * (p - y)) + 0.01 * theta)
        theta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    slope = max(theta[0] / spread, 0.0)
    return slope, theta[1] - slope * center


def fit(sample: list[tuple[str, int]], counts: dict, p: Parameters = Parameters()) -> Model:
    y = np.array([int(label) for _, label in sample])
    share = sum(n for label, n in counts.items() if label) / max(1, sum(counts.values()))
    if len(set(y.tolist())) < 2:
        z = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
        return Model(np.zeros(1 << p.bits), z, p.orders, p.bits, p.top)
    apart = np.arange(len(y)) % 4 == 3
    ids: dict[str, int] = {}
    own = [np.fromiter({ids.setdefault(w, len(ids)) for w in WORD.findall(t.lower())}, np.int64) for t, _ in sample]
    bags = Bags(list(ids), p.orders, p.bits)
    types = np.repeat(np.arange(len(ids)), np.diff(bags.starts))  # a type that splits into more words counts as all of them
    pairs = list(bags.grams())
    bucket, of = np.concatenate([b.astype(np.int32) for b, _ in pairs]), types[np.concatenate([w for _, w in pairs])].astype(np.int32)
    del pairs, bags, types
    order = np.argsort(of, kind="stable")
    bucket, of = bucket[order], of[order]
    del order
    first = np.searchsorted(of, np.arange(len(ids) + 1))
    part = (1 / np.maximum(np.diff(first), 1))[of].astype(np.float32)
    docs = np.flatnonzero(~apart)
    toxic, clean = (np.bincount(np.concatenate([own[d] for d in docs if y[d] == k] or [np.zeros(0, np.int64)]), minlength=len(ids)) for k in (1, 0))
    seen = toxic + clean
    model, rng = Embedder(1 << p.bits, 2, p.dims), np.random.default_rng(3)

    def learn_bags(groups: list[np.ndarray], wanted: np.ndarray) -> None:
        """One step on the means over groups of words."""
        which = np.concatenate(groups)
        share = np.repeat([1 / len(g) for g in groups], [len(g) for g in groups])
        sizes = first[which + 1] - first[which]
        at = np.repeat(first[which] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        ends = np.cumsum(np.add.reduceat(sizes, np.cumsum([0, *map(len, groups)])[:-1]))
        full = np.diff(ends, prepend=0) > 0
        if full.any():
            model.step(bucket[at], (part[at] * np.repeat(share, sizes)).astype(np.float32), np.concatenate([[0], ends[full]]), wanted[full], p.rate)

    def learn(which: np.ndarray, wanted: np.ndarray) -> None:
        learn_bags([which[i : i + 1] for i in range(len(which))], wanted)

    # one document says little of a word: shares are drawn towards that of all documents, and words of one document wait
    usual = float((y[docs] == 1).mean())
    toxicity = (toxic + p.prior * usual) / (seen + p.prior)
    known = np.flatnonzero(seen > 1) if (seen > 1).any() else np.flatnonzero(seen)
    weight = np.minimum(seen, 20)
    wanted = np.stack([(1 - toxicity) * weight, toxicity * weight], axis=1)
    blocks = max(1, len(known) // 2048)
    for _ in range(max(p.epochs, -(-p.steps // blocks))):
        for some in np.array_split(rng.permutation(known), blocks):
            learn(some, wanted[some])

    def of_types() -> np.ndarray:
        """Each distinct word's logit, without the bias."""
        table = model.table()
        return np.bincount(of, weights=(table[:, 1] - table[:, 0])[bucket] * part, minlength=len(ids))

    def top_words(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each document its top words, and the mean of their logits."""
        score = of_types()
        chosen = [own[d][np.argsort(-score[own[d]], kind="stable")[: p.top]] for d in which]
        return chosen, np.array([score[c].mean() if len(c) else np.nan for c in chosen])

    blocks = max(1, len(docs) // 512)
    for _ in range(max(p.rounds, -(-p.steps // blocks // 4))):
        chosen, _ = top_words(docs)
        full = np.flatnonzero([len(c) > 0 for c in chosen])
        for some in np.array_split(rng.permutation(full), blocks):
            learn_bags([chosen[i] for i in some], np.stack([1 - y[docs[some]], y[docs[some]]], axis=1).astype(float))
    kept = np.flatnonzero(apart) if apart.any() else np.arange(len(y))
    _, z = top_words(kept)
    z = np.where(np.isnan(z), np.nanmin(np.append(z, 0.0)), z)
    weights = np.where(y[kept] == 1, share * len(kept) / max(1, (y[kept] == 1).sum()), (1 - share) * len(kept) / max(1, (y[kept] == 0).sum()))
    slope, shift = curve(z, y[kept], weights)
    table = model.table()
    return Model((table[:, 1] - table[:, 0]) * slope, shift, p.orders, p.bits, p.top)


def learn(documents: DataFrame, labels: DataFrame, p: Parameters = Parameters()) -> Model:
    """A model of labels.toxic, from documents that are not held out."""
    own = labels.filter(~held_out() & F.col("toxic").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("label"))
    model = fit(*texts_of(documents, own, p.per_class, 2 * p.per_class, p.most_chars), p)
    release()
    return model


def score(documents: DataFrame, model: Model, threshold: float = THRESHOLD, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """documents with score (0 to 1) and predicted (1 if score >= threshold), by these names; one narrow pass over whole texts."""
    kept = [f for f in documents.schema.fields if f.name.lower() not in {n.lower() for n in names}]
    schema = T.StructType([*kept, T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, texts in slices(batches, "text", PIECE):
            s = shared.value.score(texts)
            arrays = [part.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=schema.names)

    return in_arrow(documents.select(*(F.col(f"`{f.name}`") for f in kept)), run, schema)
