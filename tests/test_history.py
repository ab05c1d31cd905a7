"""Snapshots kept over time, against the operators that read them whole."""

import random

import pytest
from pyspark.sql import functions as F

from tidemill import registry
from tidemill.operators import history, snapshots

SF = "/root/testdata/sf0.001"
POSTING = "key string, family_id string, company string, title string, countries array<string>, open_to_colombia boolean, min_years int, english_level string, pay_usd_hour_max double, pay_usd_year_max double, published date, url string, other string"


def test_kept_snapshots_are_compared_without_a_shuffle(spark):
    before, now = registry._kept_cuts(spark, *registry._cuts(spark, SF), "o_orderkey")
    diff = snapshots.diff(before.rows, now.rows, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])
    changes = history.signed(before.rows, now.rows, ["o_orderkey"], ["o_orderkey", "o_orderstatus"])
    for df in (diff, changes):
        df.collect()
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    wider = history.keep(registry._cuts(spark, SF)[1], ["o_orderkey"], 2 * before.rows.rdd.getNumPartitions())
    assert snapshots.diff(before.rows, wider.rows, ["o_orderkey"], ["o_orderstatus", "o_totalprice"]).count() == diff.count()
    for k in (before, now, wider):
        k.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("kept_")]


def postings(rng, n):
    import datetime as dt

    maybe = lambda x: rng.choice([None, x])
    return {
        f"k{i}": (f"f{rng.randrange(6)}", f"c{rng.randrange(3)}", f"t{rng.randrange(3)}", maybe(rng.sample(["CO", "US", "FR", "BR"], rng.randrange(4))), rng.choice([True, False, None]), maybe(rng.randrange(9)),
                  rng.choice([None, "", "B2", "C1"]), maybe(rng.randrange(90) / 4), maybe(1e5), maybe(dt.date(2024, 1, 1 + rng.randrange(28))), maybe(f"u{i}"), "x")
        for i in rng.sample(range(60), n)
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_families_kept_up_over_several_diffs_equal_a_full_rollup(spark, seed):
    rng = random.Random(seed)
    columns = ["key", *history.FAMILY_COLUMNS]
    frame = lambda rows: spark.createDataFrame([(k, *v) for k, v in rows.items()], POSTING)
    now = postings(rng, 30)
    entries = history.ledger(frame(now), "key")
    families = history.families_of(entries)
    for n in (28, 0, 45, 45):
        was, now = now, postings(rng, n) if n in (0, 28) else {**now, **postings(rng, n // 3)}
        changes = history.signed(frame(was), frame(now), ["key"], columns)
        entries, families = history.kept_up(entries, families, changes, "key")
        entries, families = (spark.createDataFrame(x.collect(), x.schema) for x in (entries, families))
        want = snapshots.families(frame(now).withColumn("countries", F.coalesce("countries", F.array().cast("array<string>"))), "key")
        assert sorted(map(str, families.select(*want.columns).collect())) == sorted(map(str, want.collect()))
        assert families.schema.simpleString() == want.schema.simpleString() or families.columns == want.columns


def test_sketches_merge_and_subtract_within_their_bound(spark):
    days = [spark.range(i * 10_000, i * 10_000 + 50_000).select(F.col("id").alias("x"), F.when(F.col("id") % 7 > 0, F.col("id") % 101).alias("y")) for i in range(4)]
    kept = [history.sketched(d, ["x", "y"]) for d in days]
    every = kept[0]
    for k in kept[1:]:
        every = every.unionByName(k)
    told = history.over_all(every, ["x", "y"]).first()
    assert abs(told["x_about"] - 80_000) < 0.08 * 80_000 and told["y_about"] == 101
    assert [r["x_n"] for r in every.select("x_n").collect()] == [50_000] * 4
    both, gone, come = history.compared(kept[0], kept[3], "x").first()
    assert all(abs(a - b) < 0.08 * 80_000 for a, b in ((both, 20_000), (gone, 30_000), (come, 30_000)))
