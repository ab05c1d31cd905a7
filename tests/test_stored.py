"""Stored tables that grow: upserts that rewrite only what they touch, checkpoints that compact."""

import hashlib
import json
from pathlib import Path

from tidemill import registry
from tidemill.operators import extraction, snapshots, upserts
from tidemill.sources import ingest, runs


def content(path):
    return {str(f.relative_to(path)): hashlib.sha256(f.read_bytes()).hexdigest() for f in Path(path).rglob("*.parquet")}


def test_upsert_leaves_untouched_files_byte_for_byte(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(f"k{i}", f"v{i}", "n") for i in range(500)], "key string, v string, note string")
    upserts.create(rows, path, "key", 32)
    before = content(path)
    new = spark.createDataFrame([("k3", "new", "x"), ("k7", "", "x"), ("added", "v", "y")], "key string, v string, extra string")
    touched = {r[0] for r in new.select(upserts.part_of("key", 32)).collect()}
    changes = {tuple(r) for r in upserts.upsert_into(path, new, "key", 32).collect()}
    assert changes == {("k3", "updated"), ("k7", "updated"), ("added", "inserted")}
    after = content(path)
    same = {f for f in before if after.get(f) == before[f]}
    assert {f.split("/")[0] for f in before} - {f"_part={p}" for p in touched} == {f.split("/")[0] for f in same} and len(touched) <= 3
    want = upserts.upsert(rows, new, "key").drop("_change")
    got = upserts.table_at(spark, path)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # again: nothing changes but files, and no rows touch nothing
    assert {r["_change"] for r in upserts.upsert_into(path, new, "key", 32).collect()} == {"unchanged"}
    settled = content(path)
    assert upserts.upsert_into(path, new.limit(0), "key", 32).count() == 0 and content(path) == settled
    assert sorted(map(tuple, upserts.table_at(spark, path).collect())) == sorted(map(tuple, want.collect()))


def test_compacted_checkpoint_equals_the_plain_one_with_few_runs(spark, tmp_path):
    path, lines = str(tmp_path / "runs"), []
    for n in range(11):
        part = [(n * 10 + i, json.dumps({"key": f"k{(n * 3 + i) % 13}", "value": {"a": n * 10 + i}})) for i in range(6)] + [(n * 10 + 9, '{"key": "torn')]
        lines += part
        runs.append(spark.createDataFrame(part, "line_no long, line string"), path, "struct<a:int>", fan=3)
        assert len(runs.runs(spark, path)) <= 2 * 3
        got = {r["key"]: r["value"]["a"] for r in runs.checkpoint(spark, path, "struct<a:int>").collect()}
        assert got == {r["key"]: r["value"]["a"] for r in ingest.checkpoint(spark.createDataFrame(lines, "line_no long, line string"), "struct<a:int>").collect()}
    # a merge that broke off before it deleted its inputs changes nothing
    spark.createDataFrame([("k0", (-1,), 0, 0)], "key string, value struct<a:int>, append long, line_no long").write.parquet(f"{path}/run-0-0")
    assert {r["key"]: r["value"]["a"] for r in runs.checkpoint(spark, path, "struct<a:int>").collect()} == got
    assert runs.checkpoint(spark, str(tmp_path / "none"), "struct<a:int>").count() == 0


def test_reports_are_in_order(spark):
    before, now = registry._cuts(spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in snapshots.in_order(snapshots.diff(before, now, ["o_orderkey"], ["o_orderstatus"]), ["o_orderkey"]).select("change", "o_orderkey").collect()]
    kinds = ["new", "closed", "changed"]
    assert rows == sorted(rows, key=lambda r: (kinds.index(r[0]), r[1])) and {k for k, _ in rows} == set(kinds)
    families = [(r["company"], r["title"]) for r in registry.family_rollup(spark, "/root/testdata/sf0.001").orderBy("company", "title").collect()]
    assert families == sorted(families)


def answer(text, fields):
    return {f: ("1", "word") for f in fields}


def test_extractor_comes_from_the_environment(monkeypatch):
    monkeypatch.delenv("TIDEMILL_EXTRACTOR", raising=False)
    assert extraction.from_environment() is None
    monkeypatch.setenv("TIDEMILL_EXTRACTOR", f"{__name__}:answer")
    function, calls = extraction.from_environment()
    assert function("x", ["a"]) == {"a": ("1", "word")} and calls == 40
    monkeypatch.setenv("TIDEMILL_CALLS", "3")
    assert extraction.from_environment()[1] == 3
