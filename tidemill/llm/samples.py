"""Bounded samples of labelled rows, for classifiers that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import local

STEPS = 1 << 62


def pick(labels: DataFrame, per_class: int, most_rows: int) -> tuple[DataFrame, dict]:
    """Of each label about `per_class` rows, chosen by a hash of doc_id, and how many rows each label has.

    labels: doc_id, label and others. So many labels that they would exceed most_rows get fewer rows each, but every label
    gets some: at most 1.25 * the greater of most_rows and the number of labels come back, in the order of the hash.
    """
    counts = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return labels.limit(0), counts
    each = max(1, min(per_class, most_rows // len(counts)))
    # 62 bits, so that some rows of a label stay however many it has
    hashed = F.xxhash64("doc_id", F.lit(11))
    rank = F.pmod(hashed, F.lit(1 << 20)) * F.lit(1 << 42) + F.pmod(F.shiftright(hashed, 20), F.lit(1 << 42))
    kind = labels.schema["label"].dataType.simpleString()
    cuts = local(labels.sparkSession, [(label, STEPS if n <= each else STEPS * each // n) for label, n in counts.items()], f"label {kind}, _cut long")
    chosen = labels.join(F.broadcast(cuts), "label").withColumn("_rank", rank).filter("_rank < _cut")
    return chosen.orderBy("_rank", "doc_id").limit(int(1.25 * each * len(counts)) + 1).drop("_rank", "_cut"), counts


def texts_of(documents: DataFrame, labels: DataFrame, per_class: int, most_rows: int, most_chars: int) -> tuple[list[tuple[str, object]], dict]:
    """(text, label) pairs of such a sample, in a fixed order; labels hold one row for each doc_id, longer texts are not learned from."""
    chosen, counts = pick(labels, per_class, most_rows)
    ids = [(r["doc_id"], r["label"]) for r in chosen.collect()]
    if not ids:
        return [], counts
    small = F.broadcast(local(documents.sparkSession, ids, labels.select("doc_id", "label").schema))
    rows = documents.select("doc_id", "text").join(small, "doc_id").filter(F.length("text") <= most_chars).select("text", "label").collect()
    return sorted((r["text"], r["label"]) for r in rows), counts
