"""Incremental variants on Structured Streaming: keep-first by key, snapshot diff and windowed counts of a request log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.operators import snapshots


def keep_first(stream: DataFrame, key: list[str], event_time: str, lateness: str) -> DataFrame:
    """The first row to arrive of each key; state is dropped once the watermark passes a row's time."""
    return stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(key)


def status_counts(stream: DataFrame, event_time: str, status: str, window: str, lateness: str) -> DataFrame:
    return stream.withWatermark(event_time, lateness).groupBy(F.window(event_time, window), status).agg(F.count("*").alias("n"))


def snapshot_diffs(stream: DataFrame, snapshot: str, diffs: str, key: list[str], signature: list[str], checkpoint: str) -> StreamingQuery:
    """Each batch is a whole snapshot: its diff against the one before goes to diffs/batch=N, then it becomes the one before.

    A batch that runs again writes the same folders, so each is there once.
    """

    def on_batch(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        before = spark.read.schema(batch.schema).parquet(f"{snapshot}/batch={n - 1}") if n else spark.createDataFrame([], batch.schema)
        snapshots.diff(before, batch, key, signature).write.mode("overwrite").parquet(f"{diffs}/batch={n}")
        batch.write.mode("overwrite").parquet(f"{snapshot}/batch={n}")

    return stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
