"""Place names by automaton, folding by tables, saved payloads as a data source."""

import json
import random
import sys
import time

import pytest
from pyspark.sql import functions as F

from tidemill.functions import folding, gazetteer, places, text
from tidemill.sources import ingest, saved


def test_automaton_equals_the_pattern(spark):
    rng = random.Random(4)
    words = [*places.CODE_OF, "x", "usa", "us", "uk", "-", ",", "mexico city", "new", "york", "u.s.a", "aus", "u.s"]
    rows = [(i, rng.choice(["", " ", ", ", ""]).join(rng.choices(words, k=rng.randrange(9)))) for i in range(400)] + [(-1, None), (-2, "")]
    df = spark.createDataFrame(rows, "i int, t string")
    both = df.select("i", F.coalesce(places.codes(F.col("t")), F.array().cast("array<string>")).alias("a"), gazetteer.codes(F.col("t"), places.CODE_OF).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in both) and any(r["b"] for r in both)
    assert [r["b"] for r in df.select(gazetteer.codes(F.col("t"), {}).alias("b")).distinct().collect()] == [[]]


def test_a_hundred_thousand_names_cost_what_ninety_do():
    rng = random.Random(5)
    many = {"".join(rng.choices("abcdefghij", k=rng.randrange(6, 14))): "XX" for _ in range(100_000)} | places.CODE_OF
    told = " and ".join(rng.choices([*places.CODE_OF, "nowhere", "elsewhere"], k=60_000))
    seconds = {}
    for names in (places.CODE_OF, many):
        made = gazetteer.automaton(tuple(sorted(names.items())))
        found = []
        for _ in range(3):
            start = time.perf_counter()
            found.append(list(gazetteer.places_in(told, made)))
            seconds.setdefault(len(names), []).append(time.perf_counter() - start)
        assert [c for c in found[0] if c != "XX"] == list(gazetteer.places_in(told, gazetteer.automaton(tuple(sorted(places.CODE_OF.items())))))
    few, more = (min(x) for x in seconds.values())
    assert more < 4 * few


def test_folding_equals_unicode_forms_for_every_character(spark):
    chars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    rows = [(i, "".join(chars[i : i + 256])) for i in range(0, len(chars), 256)] + [(-1, "Straße ÁÉ ﬁn é 한 한글 ´"), (-2, ""), (-3, None)]
    got = {r["i"]: r["f"] for r in spark.createDataFrame(rows, "i int, t string").select("i", folding.fold(F.col("t")).alias("f")).collect()}
    assert all(got[i] == (None if t is None else folding.folded(t)) for i, t in rows)


def test_folding_and_family_ids_need_no_python(spark):
    df = spark.createDataFrame([("Ünï  Çode",)], "t string")
    plan = df.select(text.fold(F.col("t")), text.family_id(F.col("t"), F.col("t")))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.first()[0] == "uni code"


@pytest.fixture
def folder(spark, tmp_path):
    for source, board in (("lever", "a"), ("lever", "b"), ("greenhouse", "a")):
        (tmp_path / source).mkdir(exist_ok=True)
        (tmp_path / source / f"{board}.json").write_text(json.dumps({"of": f"{source} {board} é"}, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "one.jsonl").write_text('{"key":"k","value":{"a":1}}\n{"key":"k","value":{"a":2}}\n{"key":"torn')
    (tmp_path / "two.jsonl").write_text('{"key":"k","value":{"a":9}}\n')
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(saved.SavedBoards)
    spark.dataSource.register(saved.SavedLines)
    yield tmp_path
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_saved_boards_are_partitions_that_filters_prune(spark, folder):
    for path in (str(folder), folder.as_uri()):
        rows = spark.read.format("saved_boards").load(path)
        assert rows.rdd.getNumPartitions() == 3 and {(r["source"], r["board"]) for r in rows.collect()} == {("lever", "a"), ("lever", "b"), ("greenhouse", "a")}
        assert rows.filter("source = 'lever'").rdd.getNumPartitions() == 2
        one = rows.filter("source = 'lever' and board in ('b', 'c') and status = 200")
        assert one.rdd.getNumPartitions() == 1 and [tuple(r) for r in one.collect()] == [("lever", "b", 200, '{"of": "lever b é"}')]
        assert rows.filter("source = 'nobody'").count() == 0
    ok, failed = ingest.answered(spark.createDataFrame([("C", "lever", "a"), ("C", "lever", "z")], ingest.BOARDS), rows)
    assert [r["board"] for r in ok.collect()] == ["a"] and [r["reason"] for r in failed.collect()] == ["no answer"]


def test_saved_lines_give_the_checkpoint(spark, folder):
    rows = spark.read.format("saved_lines").load(str(folder))
    assert rows.filter("name = 'one'").rdd.getNumPartitions() == 1
    got = ingest.checkpoint(rows.filter("name = 'one'"), "struct<a:int>").collect()
    assert [(r["key"], r["value"]["a"]) for r in got] == [("k", 2)]
    assert spark.read.format("saved_lines").load(str(folder / "none")).count() == 0
