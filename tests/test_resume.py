"""A Bloom filter before the anti join: the same rows as without it, few of them shuffled."""

from collections import Counter

import pytest

from tidemill.sources import ingest, resume


def rows_of(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("kind", ["long", "string"])
def test_filtered_resume_equals_the_plain_one(spark, kind):
    todo = spark.range(6000).selectExpr(f"cast(nullif(id % 4000, 7) as {kind}) k", "id v")
    done = spark.range(1500).selectExpr(f"cast(nullif(id * 3, 9) as {kind}) k", "1 extra").union(spark.range(50).selectExpr(f"cast(id as {kind})", "2"))
    want = rows_of(ingest.remaining(todo, done, "k").select("k", "v"))
    assert rows_of(resume.remaining(todo, done, "k")) == want
    assert rows_of(resume.remaining(todo, done, "k", most_bytes=2048)) == want  # a dense filter
    assert resume.filter_of(done, "k", most_bytes=64) is None and rows_of(resume.remaining(todo, done, "k", most_bytes=64)) == want


def test_few_rows_are_shuffled_and_the_filter_grows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(resume, "WORDS", 512)
    todo = spark.range(40_000).selectExpr("id k", "repeat('x', 50) payload")
    done = spark.range(8_000).selectExpr("id * 5 + 100000 * (id % 2) k")
    hits = todo.join(done, "k", "left_semi").count()
    known = resume.grown(resume.filter_of(done.filter("k % 2 = 0"), "k", expected=8000), done.filter("k % 2 = 1"), "k")
    assert known.parts == 4 and known.table.count() == 4
    surely, maybe = resume.split(todo, known, "k")
    n = maybe.count()
    assert hits <= n <= hits + 0.06 * 40_000 and n + surely.count() == 40_000
    assert resume.passes(known) < 0.06
    plan = surely._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan and "hashpartitioning" not in plan and "Python" not in plan
    assert rows_of(resume.remaining(todo, done, "k", known)) == rows_of(ingest.remaining(todo, done, "k").select("k", "payload"))
    resume.save(known, str(tmp_path / "f"))
    again = resume.load(spark, str(tmp_path / "f"))
    assert (again.parts, again.words) == (known.parts, known.words) and rows_of(resume.split(todo, again, "k")[1]) == rows_of(maybe)


def test_odd_done_sets(spark):
    todo = spark.createDataFrame([(1, "a"), (None, "b"), (1, "a"), (-5, "c")], "k int, part string")
    none = spark.createDataFrame([], "k long")
    assert rows_of(resume.remaining(todo, none, "k")) == rows_of(todo)
    assert rows_of(resume.remaining(todo, spark.createDataFrame([(None,), (-5,)], "k long"), "k")) == Counter([(1, "a"), (1, "a"), (None, "b")])
    assert resume.remaining(todo.limit(0), none, "k").count() == 0
    with pytest.raises(ValueError):
        resume.remaining(todo, spark.createDataFrame([("1",)], "k string"), "k")
    with pytest.raises(ValueError):
        resume.filter_of(spark.createDataFrame([(1.0,)], "k double"), "k")
