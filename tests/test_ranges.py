"""Pacing of a log in which one host holds most requests."""

import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import fetchlog


@pytest.mark.parametrize("part_rows,stride", [(40, 4), (40, 64), (1 << 20, 64)])
def test_large_hosts_are_paced_in_ranges(spark, monkeypatch, part_rows, stride):
    monkeypatch.setattr(fetchlog, "PART_ROWS", part_rows)
    monkeypatch.setattr(fetchlog, "STRIDE", stride)
    rng = random.Random(3)
    # a third of all requests have one host, those of another come at once, one host is null
    hosts = ["hot"] * 400 + [None] * 150 + [f"h{i % 100}" for i in range(500)]
    rng.shuffle(hosts)
    order = rng.sample(range(10_000), len(hosts))
    rows = list(zip(hosts, order, (float(rng.randrange(4000)) for _ in hosts), strict=True))
    rows += [("burst", 5_000.0 + i / 1000, 10.0) for i in range(200)]
    want, last = {}, {}
    for host, at, arrival in sorted(rows, key=lambda r: r[1]):
        last[host] = max(arrival, last[host] + 3.0) if host in last else arrival
        want[host, float(at)] = last[host]
    df = spark.createDataFrame([(h, float(o), a) for h, o, a in rows], "host string, n double, at double").repartition(5)
    ranges = fetchlog._in_ranges(df, "host", "n")
    assert (ranges is None) == (part_rows > 1000)
    if ranges is not None:
        sizes = {(r["host"], r["_range"]): r["count"] for r in ranges.groupBy("host", "_range").count().collect()}
        assert max(sizes.values()) <= part_rows and {r for h, r in sizes if h and h[0] == "h" and h != "hot"} == {0}
        assert len([1 for h, _ in sizes if h == "burst"]) >= 5
    got = {(r["host"], r["n"]): r["slot"] for r in fetchlog.paced(df, "host", "n", F.col("at"), F.lit(3.0)).collect()}
    assert got == want
