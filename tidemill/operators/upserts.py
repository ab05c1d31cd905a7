"""Idempotent keyed upsert: match by key, keep hand-made columns, never overwrite with an empty value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.files import forget, kept


def upsert(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Both as string cells. The merged table, one row for each key, with _change (inserted, updated, unchanged or kept).

    Columns of target stay, in order; new ones follow. Of target rows that share a key the last one counts; incoming rows
    that share a key are merged one after another, so that the last filled cell of each column counts. What is last, a
    column _order says; without one, the greatest row by all its cells.
    """
    mine, theirs = ([c for c in df.columns if c not in ("_order", key)] for df in (target, rows))
    columns = [c for c in target.columns if c != "_order"] + [c for c in rows.columns if c not in target.columns and c != "_order"]
    at = lambda df: F.col("_order") if "_order" in df.columns else F.struct(*df.columns)
    old = target.groupBy(key).agg(F.lit(True).alias("_a"), *(F.max_by(c, at(target)).alias(f"_old_{columns.index(c)}") for c in mine))
    new = rows.groupBy(key).agg(F.lit(True).alias("_b"), *(F.max_by(c, F.when(F.col(c) != "", at(rows))).alias(f"_new_{columns.index(c)}") for c in theirs))
    both = old.join(new, key, "full_outer")
    was = {c: F.coalesce(F.col(f"_old_{i}"), F.lit("")) if c in mine else F.lit("") for i, c in enumerate(columns) if c != key}
    now = {c: F.coalesce(F.col(f"_new_{columns.index(c)}"), was[c]) if c in theirs else was[c] for c in was}
    same = F.lit(True)
    for c in now:
        same = same & (was[c] == now[c])
    change = F.when(F.col("_a").isNull(), "inserted").when(F.col("_b").isNull(), "kept").when(same, "unchanged").otherwise("updated")
    return both.select(*(F.col(key) if c == key else now[c].alias(c) for c in columns), change.alias("_change"))


def tally(merged: DataFrame) -> DataFrame:
    return merged.agg(*(F.count_if(F.col("_change") == c).alias(c) for c in ("inserted", "updated", "unchanged")))


# A stored table that an upsert rewrites only in part: a folder for each part of the keys (by their hash), so that a few rows
# touch a few folders and all other files stay as they are. Spark replaces the folders that it writes to.

PART = "_part"


def part_of(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _write(rows: DataFrame, path: str, key: str, parts: int) -> None:
    placed = rows.withColumn(PART, part_of(key, parts)).repartition(PART)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)


def create(rows: DataFrame, path: str, key: str, parts: int) -> None:
    """rows (string cells) as a stored table in so many parts: as many as keep a part at a file's size."""
    _write(rows, path, key, parts)


def table_at(spark: SparkSession, path: str) -> DataFrame:
    """The stored table. A column that a part doesn't have yet, because nothing has touched it since, is empty there."""
    rows = spark.read.option("mergeSchema", True).parquet(path).drop(PART)
    return rows.select(*(F.coalesce(c, F.lit("")).alias(c) for c in rows.columns))


def upsert_into(path: str, rows: DataFrame, key: str, parts: int) -> DataFrame:
    """Merges rows into a stored table as upsert() does; the keys that it merged, each with _change.

    Only parts that hold a key of rows are read and rewritten. Spark replaces them one by one when all are written: a run
    that breaks off there leaves some parts as they were, and running it again gives the same table.
    """
    spark = rows.sparkSession
    incoming = kept(rows)
    touched = [r[0] for r in incoming.select(part_of(key, parts)).distinct().collect()]  # no more than there are parts
    stored = spark.read.option("mergeSchema", True).parquet(path).filter(F.col(PART).isin(touched)).drop(PART)
    target = stored.select(*(F.coalesce(c, F.lit("")).alias(c) for c in stored.columns))
    merged = kept(upsert(target, incoming, key))
    if touched:
        _write(merged.drop("_change"), path, key, parts)
    changes = kept(merged.filter("_change <> 'kept'").select(key, "_change"))
    forget(incoming, merged)
    return changes
