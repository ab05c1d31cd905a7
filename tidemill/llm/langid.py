"""Language ID: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy, calibrated rejection.

The text's vector is the mean of the vectors of all n-grams of all its words; one linear softmax reads it. Very long texts
are read in parts, whose sums add up. A part of
the sample, kept apart, sets the temperature of the probabilities and the score below which a guess is rejected: the
lowest score that still keeps `keep` of the right guesses there, and never more than `most`.

Defined results: a null text or one without a letter is `und` with score 0. Without any labelled row every text is
`und`. Equal texts have equal results. Ties between languages go to the first in code point order; repeated rows are rows
of their own. Every value of lang in the sample can be predicted: the model takes memory for each. Other columns of the
input stay unless their names are those of the result (lang_pred, score and accepted, in any case of letters), which are
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.codes import LETTER, kinds, pack
from tidemill.llm.common import PIECE, held_out, in_arrow, local, pieces_of, release, slices
from tidemill.llm.samples import pick
from tidemill.llm.subword import Bags, Embedder, by_text, softmax

UNDETERMINED = "und"


@dataclass(frozen=True)
class Parameters:
    #: The bound of the sample: about so many documents of each language (fewer of each if there are many languages, so
    #: that all come to so many rows), none longer than so many code points, all together no more than most_total.
    per_class: int = 700
    most_rows: int = 50_000
    most_chars: int = 50_000
    most_total: int = 100_000_000
    orders: tuple[int, ...] = (3, 4)
    bits: int = 16
    dims: int = 16
    epochs: int = 12
    rate: float = 0.3
    keep: float = 0.999
    most: float = 0.5


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    heat: float
    least: float
    orders: tuple[int, ...]
    bits: int

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: the sum of its n-grams' logits, their number, and how many letters it has."""
        if any(len(t) > PIECE for t in texts):
            parts = [[sum(x) for x in zip(*(self.sums([p]) for p in pieces_of(t)))] for t in texts]
            return tuple(np.concatenate([own[k] for own in parts]) for k in range(3))
        bags = Bags(texts, self.orders, self.bits)
        total, count = bags.sums(self.table)
        codes, ends = pack(texts)
        letters = np.add.reduceat((kinds()[codes] == LETTER).astype(np.int64), np.concatenate([[0], ends[:-1] + 1])) if texts else np.zeros(0, np.int64)
        return by_text(total, bags.starts, np.add, 0.0), by_text(count, bags.starts, np.add, 0.0), letters

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages or not texts:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        total, count, letters = self.sums(texts)
        probable = np.round(softmax((total / np.maximum(count, 1)[:, None] + self.bias) / self.heat), 6)
        best = probable.argmax(axis=1)
        score = np.where(letters > 0, probable[np.arange(len(texts)), best], 0.0)
        return [self.languages[k] if n else UNDETERMINED for k, n in zip(best, letters, strict=True)], score


def fit(sample: list[tuple[str, str]], p: Parameters = Parameters()) -> Model:
    languages = sorted({label for _, label in sample})
    if not languages:
        return Model([], np.zeros((1 << p.bits, 1)), np.zeros(1), 1.0, 0.0, p.orders, p.bits)
    y = np.array([languages.index(label) for _, label in sample])
    bucket, part, starts = [], [], [0]
    for text, _ in sample:
        pairs = list(Bags([text], p.orders, p.bits).grams())
        own, n = np.unique(np.concatenate([b for b, _ in pairs] or [np.zeros(0, np.int64)]), return_counts=True)
        if not len(own):
            own, n = np.zeros(1, np.int64), np.zeros(1)
        bucket.append(own)
        part.append((n / max(n.sum(), 1)).astype(np.float32))
        starts.append(starts[-1] + len(own))
    flat, share, starts = np.concatenate(bucket), np.concatenate(part), np.array(starts)
    apart = np.arange(len(y)) % 5 == 4 if len(y) >= 20 else np.zeros(len(y), bool)
    model, rng = Embedder(1 << p.bits, len(languages), p.dims), np.random.default_rng(5)

    def bags(which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = starts[which + 1] - starts[which]
        own = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(starts[which] - own[:-1], sizes) + np.arange(own[-1])
        return flat[at], share[at], own

    rows = np.flatnonzero(~apart)
    for _ in range(p.epochs):
        for some in np.array_split(rng.permutation(rows), max(1, len(rows) // 64)):
            model.step(*bags(some), np.eye(len(languages))[y[some]], p.rate)
    check = np.flatnonzero(apart) if apart.any() else rows
    z, _ = model.logits(*bags(check))

    def loss(heat: float) -> float:
        return float(-np.log(softmax(z / heat)[np.arange(len(check)), y[check]] + 1e-12).mean())

    heat = min(np.geomspace(0.05, 5, 60), key=loss)
    probable = softmax(z / heat)
    right = np.sort(probable.max(axis=1)[probable.argmax(axis=1) == y[check]])
    least = min(p.most, float(np.quantile(right, 1 - p.keep))) if len(right) else 0.0
    return Model(languages, model.table(), model.bias.astype(np.float64), float(heat), least, p.orders, p.bits)


def learn(documents: DataFrame, p: Parameters = Parameters()) -> Model:
    """A model of lang, from text and non-null lang of documents that are not held out."""
    known = documents.filter(~held_out() & F.col("lang").isNotNull() & (F.length("text") <= p.most_chars)).select("doc_id", F.col("lang").cast("string").alias("label"), "text")
    # ids are ranked and collected first, so that no task sorts texts, and the driver gets only those it learns from
    chosen, _ = pick(known.select("doc_id", "label", F.length("text").alias("size")), p.per_class, p.most_rows)
    ids, total = {}, 0
    for r in chosen.collect():
        total += r["size"]
        if total > p.most_total:
            break
        ids[r["doc_id"], r["label"]] = None
    sample = []
    if ids:
        small = F.broadcast(local(documents.sparkSession, list(ids), known.select(F.col("doc_id").alias("_id"), F.col("label").alias("_label")).schema))
        sample = known.join(small, known["doc_id"].eqNullSafe(small["_id"]) & (known["label"] == small["_label"])).select("text", "label").collect()
    model = fit(sorted((r["text"], r["label"]) for r in sample), p)
    release()
    return model


def identify(documents: DataFrame, model: Model, names: tuple[str, str, str] = ("lang_pred", "score", "accepted")) -> DataFrame:
    """documents with lang_pred, score and accepted (false: rejected), by these names; one narrow pass over whole texts."""
    kept = [f for f in documents.schema.fields if f.name.lower() not in {n.lower() for n in names}]
    schema = T.StructType([*kept, *(T.StructField(n, kind()) for n, kind in zip(names, (T.StringType, T.DoubleType, T.BooleanType)))])
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, texts in slices(batches, "text", PIECE):
            found, s = shared.value.predict(texts)
            accepted = [name != UNDETERMINED and bool(x >= shared.value.least) for name, x in zip(found, s, strict=True)]
            arrays = [part.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(found, pa.string()), pa.array(s), pa.array(accepted, pa.bool_())], names=schema.names)

    return in_arrow(documents.select(*(F.col(f"`{f.name}`") for f in kept)), run, schema)
