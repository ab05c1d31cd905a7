"""Pacing and blocks of a request log as a stream: what paced() and blocked_before() give for the whole log, batch by batch.

Each host's state is the slot of its last request and whether one was blocked, so a request costs the same however long
the log is. A timer drops the state of a host once no request can come any more that it would delay: the watermark has
passed its next slot, and a later request gets its own arrival as its slot with or without the state. A blocked host's
state stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STATE = "slot double, interval double, blocked boolean"


class Paced(StatefulProcessor):
    """Rows (host, order, arrival, interval, blocked) to rows with slot and fails_fast."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("host", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        told = pd.concat(rows).sort_values("order", kind="stable")
        slot, interval, blocked = self.state.get() if self.state.exists() else (None, 0.0, False)
        slots, fast = [], []
        for arrival, own, block in zip(told["arrival"], told["interval"], told["blocked"], strict=True):
            slot = arrival if slot is None else max(arrival, slot + own)
            interval = own
            slots.append(slot)
            fast.append(blocked)
            blocked = blocked or bool(block)
        self.state.update((float(slot), float(interval), blocked))
        if not blocked:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(int((slot + interval) * 1000) + 1)
        host = pd.Series([key[0]] * len(told), dtype=object, index=told.index)
        yield told.assign(host=host, slot=slots, fails_fast=fast)[["host", "order", "slot", "fails_fast"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def paced(requests: DataFrame, host: str, order: str, arrival: str, interval: Column, blocked: Column, lateness: str) -> DataFrame:
    """host, order, slot (seconds), fails_fast of a stream of requests.

    arrival: a timestamp; requests of a host come in order over the batches, in any order within one, and none later than
    `lateness` behind the latest arrival. A host's interval is one for all its requests. RocksDB must be the state store.
    """
    rows = requests.withWatermark(arrival, lateness).select(
        F.col(host).alias("host"), F.col(order).alias("order"), F.col(arrival).cast("timestamp").cast("double").alias("arrival"), F.col(arrival).alias("_at"), interval.cast("double").alias("interval"), blocked.alias("blocked")
    )
    schema = T.StructType([T.StructField("host", rows.schema["host"].dataType), T.StructField("order", rows.schema["order"].dataType), T.StructField("slot", T.DoubleType()), T.StructField("fails_fast", T.BooleanType())])
    return rows.groupBy("host").transformWithStateInPandas(statefulProcessor=Paced(), outputStructType=schema, outputMode="Append", timeMode="EventTime")
