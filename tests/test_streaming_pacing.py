"""The streaming pacer against the batch operators, over the same log in any batches."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import fetchlog
from tidemill.streaming import pacing

KIND = "host string, n long, at timestamp, blocked boolean"


def log(rng):
    rows, now = [], dt.datetime(2026, 1, 1)
    for n in range(240):
        now += dt.timedelta(seconds=rng.choice([0, 0, 1, 2, 40]))
        host = rng.choice(["hot", "hot", "a", "b", None])
        rows.append((host, n, now, host in ("a", None) and n % 37 == 5))
    return rows


@pytest.mark.parametrize(("seed", "batches"), [(1, 2), (2, 5)])
def test_stream_equals_batch_in_any_batches(spark, tmp_path, seed, batches):
    rng = random.Random(seed)
    rows = log(rng)
    cuts = sorted(rng.sample(range(1, len(rows)), batches - 1))
    os.makedirs(f"{tmp_path}/src")
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)], strict=True)):
        part = rows[a:b]
        rng.shuffle(part)
        spark.createDataFrame(part, KIND).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        (f,) = glob.glob(f"{tmp_path}/in/{i}/part*")
        os.rename(f, f"{tmp_path}/src/{i}.parquet")
        os.utime(f"{tmp_path}/src/{i}.parquet", (i + 1, i + 1))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/src")
        told = pacing.paced(stream, "host", "n", "at", F.lit(3), F.col("blocked"), "10 seconds")
        query = told.writeStream.format("memory").queryName(f"paced{seed}").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        assert query.awaitTermination(240)
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = {r["order"]: (r["slot"], r["fails_fast"]) for r in spark.table(f"paced{seed}").collect()}
    whole = spark.createDataFrame(rows, KIND)
    slots = fetchlog.paced(whole, "host", "n", F.col("at").cast("double"), F.lit(3.0))
    fast = fetchlog.blocked_before(whole, "host", "n", F.col("blocked")).select("n", "fails_fast")
    want = {r["n"]: (r["slot"], r["fails_fast"]) for r in slots.join(fast, "n").collect()}
    assert got == want and any(f for _, f in want.values())
