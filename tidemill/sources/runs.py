"""A checkpoint that many runs append to, as sorted runs that merge: reading it costs the same however often it was written.

Every append is a run of level 0. As soon as a level holds FAN runs they become one run of the next level, in which only
the last value of each key is left; so n appends leave less than FAN * log_FAN(n) runs. A merge that breaks off leaves
its inputs, or both (they say the same): readers take the last value of a key over all runs, by append and line.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.files import delete, move, names

FAN = 8
#: Rows of a file of a merged run, about.
FILE_ROWS = 1 << 20


def parsed(lines: DataFrame, value: str) -> DataFrame:
    """key, value, line_no of a checkpoint's lines (line_no, line); a torn line is skipped."""
    return lines.select(F.from_json("line", f"struct<key:string,value:{value}>").alias("r"), "line_no").filter("r.key is not null").select("r.key", "r.value", "line_no")


def _last(rows: DataFrame) -> DataFrame:
    at = F.struct("append", "line_no")
    return rows.groupBy("key").agg(F.max_by(F.struct("value", "append", "line_no"), at).alias("r")).select("key", "r.*")


def _written(rows: DataFrame, path: str, name: str, files: int) -> None:
    """A run, sorted by key, that is there as a whole or not at all."""
    spark, beside = rows.sparkSession, f"{path}/_new-{uuid.uuid4().hex}"
    rows.repartitionByRange(files, "key").sortWithinPartitions("key").write.parquet(beside)
    move(spark, beside, f"{path}/{name}")


def runs(spark: SparkSession, path: str) -> list[tuple[int, int, str]]:
    """Level, last append and name of each run, in order."""
    found = [n for n in names(spark, path) if n.startswith("run-")]
    return sorted((int(n.split("-")[1]), int(n.split("-")[2]), n) for n in found)


def append(lines: DataFrame, path: str, value: str, fan: int = FAN) -> None:
    """Adds lines as a run, and merges levels that are full."""
    spark = lines.sparkSession
    number = max((last for _, last, _ in runs(spark, path)), default=-1) + 1
    _written(_last(parsed(lines, value).withColumn("append", F.lit(number).cast("long"))), path, f"run-0-{number}", 1)
    compact(spark, path, fan)


def compact(spark: SparkSession, path: str, fan: int = FAN) -> None:
    """Merges the runs of each level that holds `fan` of them, from the lowest up."""
    level = 0
    while True:
        mine = [r for r in runs(spark, path) if r[0] == level]
        if len(mine) >= fan:
            both = spark.read.parquet(*(f"{path}/{name}" for _, _, name in mine))
            _written(_last(both), path, f"run-{level + 1}-{mine[-1][1]}", -(-both.count() // FILE_ROWS) or 1)
            for _, _, name in mine:
                delete(spark, f"{path}/{name}")
        if level >= max((lv for lv, _, _ in runs(spark, path)), default=0):
            return
        level += 1


def checkpoint(spark: SparkSession, path: str, value: str) -> DataFrame:
    """key, value: the last value of each key over all runs."""
    found = [f"{path}/{name}" for _, _, name in runs(spark, path)]
    schema = f"key string, value {value}, append long, line_no long"
    rows = spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)
    return _last(rows).select("key", "value")
