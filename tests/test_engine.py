"""The engine's own operators: every query against DuckDB, and the cases that the driver's tables do not hold."""

import datetime as dt
import glob
import json
import os
import unicodedata

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemill import cli, registry
from tidemill.functions import places, text
from tidemill.operators import contracts, extraction, fetchlog, snapshots, upserts
from tidemill.plans import books, jobs, quotes
from tidemill.sources import fetch, ingest, parsers, sinks
from tidemill.streaming import incremental

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return v


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    want = duck.sql(registry.ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    key = lambda r: tuple(str(x) for x in r)
    a = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=key)
    b = sorted((tuple(plain(r[want.columns.index(c)]) for c in columns) for r in want.fetchall()), key=key)
    assert a == b


def values(spark, kind, rows, column):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], f"i int, x {kind}").orderBy("i").select(column).collect()]


def test_normalizers(spark):
    odd = ["  a \x1c b c ", None, "á", "\x85x"]
    assert values(spark, "string", odd, text.clean(F.col("x"))) == ["a b c", "", "á", "x"]
    assert values(spark, "string", ["Straße ÁÉ", "ﬁn", "Ø"], text.fold(F.col("x"))) == ["strasse ae", "fin", "ø"]
    assert unicodedata.normalize("NFC", "á") == "á"
    assert [str(x) for x in values(spark, "string", ["£51.77", "$1,234.50", "free", "10-20"], text.money(F.col("x")))] == ["51.770000", "1234.500000", "None", "None"]
    assert [str(x) for x in values(spark, "string", ["$ 1.234.567,89", "COP 25.000"], text.money(F.col("x"), ","))] == ["1234567.890000", "25000.000000"]
    assert [text.column_letter(i) for i in (0, 25, 26, 702)] == ["A", "Z", "AA", "AAA"]
    assert values(spark, "string", ["<p>a <b>b</b></p><script>x</script>c<br>d &amp;"], text.html_to_text(F.col("x"))) == ["a\nb\nc\nd &"]
    assert values(spark, "string", ["Campus (U.S.)", "Medellín / São Paulo", "australia", None], places.codes(text.fold(F.col("x")))) == [["US"], ["BR", "CO"], ["AU"], []]


def test_three_valued_or(spark):
    rows = [(1, True), (1, None), (2, False), (2, None), (3, False), (4, None)]
    got = spark.createDataFrame(rows, "k int, x boolean").groupBy("k").agg(snapshots.three_valued_or(F.col("x")).alias("x")).orderBy("k").collect()
    assert [r["x"] for r in got] == [True, None, False, None]


def test_gate(spark):
    rows = spark.createDataFrame([(1, "a", 0, None), (1, "b", 1, "x"), (2, "", 5, ""), (3, "c", -1, "y")], "k int, name string, n int, note string")
    spec = contracts.Spec("t", ("k",), {"n: below 0": F.col("n") >= 0}, expected=2, least_fill={"n": 1.0, "note": 0.5}, columns=("k", "name", "n", "note"))
    got = {r["name"]: r for r in contracts.gate(rows, spec, [F.col("name")]).collect()}
    assert [got[n]["status"] for n in ("schema", "unique key", "coverage", "fill rate n", "fill rate note")] == ["FAIL", "FAIL", "PASS", "PASS", "FAIL"]
    assert {r["verdict"] for r in got.values()} == {"NOT READY"} and got["unique key"]["detail"] == "1 duplicated keys"
    assert contracts.validated(rows.withColumn("more", F.lit(1)), spec).filter("size(_errors) = 0").count() == 0
    assert [r["fill_rate"] for r in contracts.fill_rates(rows.limit(0), ["n", "note"]).collect()] == [0.0, 0.0]


@pytest.mark.parametrize("sizes,bad", [([20, 20, 7], 0), ([20, 0, 7], 1), ([20, 20, 0], 1)])
def test_page_yield(spark, sizes, bad):
    assert contracts.page_yield(spark.createDataFrame([("a", i, n) for i, n in enumerate(sizes)], "listing string, page int, n int"), 20).count() == bad


def test_postings_of_one_snapshot_follow_from_the_last_and_the_diff(spark):
    before = spark.createDataFrame([(i, "a") for i in range(20)], "k int, v string")
    now = spark.createDataFrame([(i, "b" if i % 5 == 0 else "a") for i in range(7, 31)], "k int, v string")
    n = {r["change"]: r["n"] for r in snapshots.diff(before, now, ["k"], ["v"]).groupBy("change").agg(F.count("*").alias("n")).collect()}
    assert 20 + n["new"] - n["closed"] == 24 and n["changed"] == 2


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([("1", "a", "mine"), ("2", "b", "")], "k string, v string, note string")
    rows = spark.createDataFrame([("2", "", "n"), ("3", "c", "")], "k string, v string, more string")
    once = upserts.upsert(target, rows, "k")
    assert {(r["k"], r["v"], r["note"], r["more"], r["_change"]) for r in once.collect()} == {("1", "a", "mine", "", "kept"), ("2", "b", "", "n", "updated"), ("3", "c", "", "", "inserted")}
    again = upserts.tally(upserts.upsert(once.drop("_change"), rows, "k")).first()
    assert (again["inserted"], again["updated"], again["unchanged"]) == (0, 0, 2)


def test_rules_and_evidence(spark):
    t = "3+ years of Python. 5 to 7 years of relevant experience.\nExperience: 40 years! Native or alternative English; pay $25.50/hr or US$ 30 per hour. 20 hours a week. 30-40 hours per week"
    got = extraction.rules(spark.createDataFrame([(1, t), (2, "nothing"), (3, None)], "k int, t string"), "k", "t").collect()
    assert len(got) == 1 and (got[0]["min_years"], got[0]["english_level"], got[0]["pay_usd_hour_max"], got[0]["hours_per_week"]) == (5, "native", 30.0, "20")
    ok = values(spark, "string", ["Pays 1,234,567 now", "ab", "PAYS  1,234,567"], extraction.supported(F.lit("It pays 1,234,567 now"), F.col("x")))
    assert ok == [True, False, True]
    assert values(spark, "double", [1234567.0, 1234571.0, 99.0], extraction.readable(F.col("x"), F.lit("up to 1,234,567"), True)) == [True, True, False]
    asked = spark.createDataFrame([("d", "We pay $40 per hour", ["pay_usd_hour_max", "english_level"])], "description_sha1 string, text string, fields array<string>")
    told = extraction.extracted(asked, lambda text, fields: {"pay_usd_hour_max": ("40", "pay $40 per hour"), "english_level": ("B2", "not there")})
    assert {r["field"]: (r["accepted"], r["reason"]) for r in told.collect()} == {"pay_usd_hour_max": (True, None), "english_level": (False, "the text has no such passage")}
    schema = extraction.answer_schema(("min_years",))
    assert schema["required"] == ["min_years"] and schema["properties"]["min_years"]["required"] == ["value", "evidence"]


def test_quotes_by_several_routes_agree(spark):
    blocks = '<div class="quote"><span class="text">“Be kind.”</span><small class="author">A B</small><a class="tag">y</a><a class="tag">x</a></div><li class="next"><a href="/page/2/">Next</a></li>'
    script = 'x; var data = [{"text": "“Be kind.”", "author": {"name": "A  B"}, "tags": ["x", "y", "x"]}];'
    rows = "<table><tr><td>“Be kind.” Author: A B</td></tr><tr><td>Tags: <a>y</a> <a>x</a></td></tr></table>"
    page = lambda h: spark.createDataFrame([("http://q/", h)], "url string, html string")
    routes = {"blocks": parsers.quotes_of_blocks(page(blocks)), "script": parsers.quotes_of_scripts(page(script)), "table": parsers.quotes_of_tables(page(rows))}
    routes = {n: r.select("text", "author", "tags") for n, r in routes.items()}
    assert {tuple(map(str, r)) for df in routes.values() for r in df.collect()} == {("Be kind.", "A B", "['x', 'y']")}

    def broken():
        raise ValueError("the page has no data")

    run = quotes.run(routes | {"browser": None, "late": broken})
    told = {r["name"]: (r["status"], r["detail"]) for r in run.checks.collect()}
    assert run.delivered.count() == 1 and told["table matches blocks"][0] == "PASS" and told["browser matches blocks"] == ("WARN", "skipped")
    assert told["late matches blocks"] == ("FAIL", "ValueError: the page has no data") and not run.ready
    assert quotes.run(routes).ready
    with pytest.raises(ValueError, match="baseline"):
        quotes.run({"late": broken})
    assert page(blocks).select(parsers.next_link("html", "url")).first()[0] == "http://q/page/2/"


def test_jobs_end_to_end(spark):
    gh = json.dumps({"jobs": [{"id": i, "title": f"Dev {i % 2}", "absolute_url": f"http://g/{i}", "location": {"name": "Remote, Colombia"}, "first_published": "2026-01-02T00:00:00Z", "content": "&lt;p&gt;3+ years of experience.&lt;/p&gt;"} for i in range(4)]})
    wk = json.dumps({"jobs": [{"shortcode": "S", "title": "Ops", "url": "http://w/1", "country": c, "city": "", "telecommuting": False, "description": "x"} for c in ("Peru", "Chile")]})
    lv = json.dumps([{"id": "u", "text": "QA", "hostedUrl": "http://l", "createdAt": 1767312000000, "workplaceType": "on-site", "categories": {"location": "London"}, "descriptionPlain": "a", "lists": [{"text": "T", "content": "<li>b</li>"}]}])
    configured = spark.createDataFrame([("G", "greenhouse", "g"), ("W", "workable", "w"), ("L", "lever", "l"), ("X", "lever", "x")], ingest.BOARDS)
    answers = spark.createDataFrame([("greenhouse", "g", 200, gh), ("workable", "w", 200, wk), ("lever", "l", 200, lv), ("lever", "x", 500, None)], "source string, board string, status int, body string")
    none = spark.createDataFrame([], jobs.POSTING)
    run = jobs.run(configured, answers, none)
    got = {r["key"]: r for r in run.delivered.collect()}
    assert run.ready and len(got) == 6 and run.failed.count() == 1
    assert got["workable:w:S"]["location"] == "Peru; Chile" and got["workable:w:S"]["countries"] == ["CL", "PE"] and got["workable:w:S"]["open_to_colombia"] is False
    assert got["lever:l:u"]["published"] == dt.date(2026, 1, 2) and got["lever:l:u"]["remote"] is False and got["greenhouse:g:1"]["min_years"] == 3
    assert run.families.count() == 4 and "first snapshot: 6 postings in 4 families" in run.changelog(dt.date(2026, 1, 3), none, True)
    silent = jobs.run(configured, answers.filter("source != 'greenhouse'").unionByName(spark.createDataFrame([("greenhouse", "g", 200, '{"jobs": []}')], answers.schema)), run.delivered.unionByName(run.delivered.withColumn("key", F.concat("key", F.lit("b")))))
    assert not silent.ready


def test_jobs_with_an_extractor(spark, tmp_path):
    texts = ["At least four (4) years in the field. Good English needed.", "Good English needed, we say. 3+ years of experience.", "Nothing at all", "Years: 7.5, ask us. Per hour we pay 31 dollars", "At least four (4) years in the field. Good English needed."]
    places = ["London", "Remote, Colombia", "London", "London", "London"]
    gh = json.dumps({"jobs": [{"id": i, "title": f"Dev {i}", "absolute_url": f"http://g/{i}", "location": {"name": p}, "first_published": "2026-01-02T00:00:00Z", "content": t} for i, (t, p) in enumerate(zip(texts, places))]})
    configured = spark.createDataFrame([("G", "greenhouse", "g"), ("X", "lever", "x"), ("Y", "lever", "y")], ingest.BOARDS)
    answers = spark.createDataFrame([("greenhouse", "g", 200, gh), ("lever", "x", 500, None), ("lever", "y", 200, "<html>")], "source string, board string, status int, body string")
    none, log = spark.createDataFrame([], jobs.POSTING), str(tmp_path / "asked")

    def extractor(text, fields):
        with open(log, "a") as f:
            f.write(text[:12] + "\n")
        every = {"min_years": ("4" if "four" in text else "7.5", "four (4) years" if "four" in text else "Years: 7.5"), "english_level": ("Good", "Good  English"), "pay_usd_hour_max": (31, "we pay 31 dollars"), "hours_per_week": ("40", "made up")}
        return every

    run = jobs.run(configured, answers, none, extractor)
    got = {r["posting_id"]: r for r in run.delivered.collect()}
    assert len(got) == 5 and run.ready
    for i in "04":
        assert got[i]["min_years"] == 4 and got[i]["english_level"] == "Good" and got[i]["pay_usd_hour_max"] is None
        assert got[i]["extracted_by"] == {"min_years": "llm", "english_level": "llm"} and got[i]["evidence"] == {"min_years": "four (4) years", "english_level": "Good English"}
    assert got["1"]["min_years"] == 3 and got["1"]["extracted_by"] == {"min_years": "rules", "english_level": "llm"}
    assert got["2"]["extracted_by"] == {} and got["3"]["min_years"] is None and got["3"]["pay_usd_hour_max"] == 31.0
    assert len(open(log).read().splitlines()) == 3
    checks = {r["name"]: r for r in run.checks.collect()}
    assert checks["fetch failures"]["status"] == "WARN" and "1 request(s)" in checks["fetch failures"]["detail"]
    assert any(n.startswith("extractor: 3 calls") for n in run.notes) and any("min_years 1" in n for n in run.notes)
    few = {r["posting_id"]: r["extracted_by"] for r in jobs.run(configured, answers, none, extractor, calls=1).delivered.collect()}
    assert [i for i, by in few.items() if "llm" in by.values()] == ["1"]
    assert all("llm" not in r["extracted_by"].values() for r in jobs.run(configured, answers, none).delivered.collect())


def test_checkpoint_and_sinks(spark, tmp_path):
    lines = spark.createDataFrame([(1, '{"key":"a","value":{"n":1}}'), (2, '{"key":"a","value":{"n":2}}'), (3, '{"key":"b","val')], "line_no int, line string")
    assert [(r["key"], r["value"]["n"]) for r in ingest.checkpoint(lines, "struct<n:int>").collect()] == [("a", 2)]
    rows = spark.createDataFrame([(1, ["a", "b"], {"k": "v"}, None, True)], "i int, l array<string>, m map<string,string>, n string, b boolean")
    sinks.write_csv(rows, str(tmp_path / "csv"))
    assert any("1,a|b," in open(f).read() and (chr(34) * 2 + "k") in open(f).read() for f in glob.glob(f"{tmp_path}/csv/part*"))
    assert tuple(sinks.cells(rows, sheet=True).first()) == ("1", "a|b", '{"k":"v"}', "", "TRUE")
    for entry in ("## one\n", "## two\n"):
        sinks.prepend_changelog(spark, f"{tmp_path}/log.md", entry)
    assert open(f"{tmp_path}/log.md").read().index("two") < open(f"{tmp_path}/log.md").read().index("one")
    sinks.add_checkpoint(rows.select("i"), f"{tmp_path}/done")
    sinks.add_checkpoint(rows.select("i"), f"{tmp_path}/done")
    assert spark.read.parquet(f"{tmp_path}/done").count() == 2
    sinks.remove_checkpoint(spark, f"{tmp_path}/done")
    assert not os.path.exists(f"{tmp_path}/done")


def test_publishing_keeps_what_is_there_until_the_new_is_whole(spark, tmp_path):
    rows = lambda n: {"rows": lambda p: spark.range(n).write.parquet(p)}
    final = f"file://{tmp_path}/f"
    assert sinks.publish(spark, False, rows(1), final) is None and sinks.current(spark, final) is None
    first = sinks.publish(spark, True, rows(1), final)

    def breaks(path):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        sinks.publish(spark, True, rows(2) | {"more": breaks}, final)
    assert sinks.current(spark, final) == first and spark.read.parquet(f"{first}/rows").count() == 1
    for n in (3, 4):
        sinks.publish(spark, True, rows(n), final)
    assert spark.read.parquet(sinks.current(spark, final) + "/rows").count() == 4
    assert len([n for n in os.listdir(f"{tmp_path}/f") if n.startswith("v")]) == 2 and not [n for n in os.listdir(f"{tmp_path}/f") if n.endswith(".tmp")]


def test_report_lists_errors_by_row(spark):
    checks = contracts.verdict(spark.createDataFrame([("a", True, "x", True), ("b", False, "y", False)], "name string, passed boolean, detail string, blocking boolean"))
    errors = spark.createDataFrame([(i, str(i), "bad") for i in range(40, 0, -1)], "row_order int, key string, errors string")
    told = sinks.report("t", checks, errors, spark.createDataFrame([("f", 0.5)], "field string, fill_rate double"), 50, 10, {"requests": 3}, ("note",), 1.234)
    assert told["verdict"] == "READY" and [e["row_order"] for e in told["errors"]] == list(range(1, 26)) and told["elapsed_s"] == 1.23
    page = sinks.markdown(told)
    assert all(x in page for x in ("# t: READY", "10 of 50 rows", "| b | WARN | y |", "| f | 50.0 % |", "- 1: bad", "- requests: 3", "- note"))
    assert "| one | 3 | 0.5 | 2 | PASS |" in sinks.strategies([{"name": "one", "rows": 3, "seconds": 0.5, "requests": 2, "status": "PASS"}])


def _book(upc, title, category, price="51.77", crumbs=True, stars="Three"):
    trail = f'<ul class="breadcrumb"><li>Home</li><li>Books</li><li>{category}</li><li>{title}</li></ul>' if crumbs else ""
    table = "".join(f"<tr><th>{k}</th><td>{v}</td></tr>" for k, v in (("UPC", upc), ("Price (excl. tax)", f"£{price}"), ("Price (incl. tax)", f"£{price}"), ("Tax", "£0.00"), ("Availability", "In stock (22 available)"), ("Number of reviews", "0")))
    return f'{trail}<div class="product_main"><h1>{title}</h1><p class="star-rating {stars}"></p></div><div id="product_description"></div><p>About {title}.</p><table class="table table-striped">{table}</table>'


@pytest.fixture(scope="module")
def shop(spark):
    base = "http://b/"
    books_ = {f"{base}book/{i}/index.html": _book(f"{i:016x}", f"Book {i}", "Travel" if i < 25 else "Poetry") for i in range(30)}
    home = '<div class="side_categories"><ul><li><a href="all">Books</a><ul><li><a href="c/travel/index.html"> Travel </a></li><li><a href="c/poetry/index.html">Poetry</a></li></ul></li></ul></div><form class="form-horizontal"><strong>30</strong> results</form>'
    pod = lambda i: f'<article class="product_pod"><h3><a href="../../book/{i}/index.html">b</a></h3></article>'
    count = lambda n: f'<form class="form-horizontal"><strong>{n}</strong></form>'
    more = '<li class="next"><a href="page-2.html">next</a></li>'
    listings = [
        ("Travel", 1, f"{base}c/travel/index.html", count(25) + "".join(map(pod, range(20))) + more),
        ("Travel", 2, f"{base}c/travel/page-2.html", count(25) + "".join(map(pod, range(20, 25)))),
        ("Poetry", 1, f"{base}c/poetry/index.html", count(5) + "".join(map(pod, range(25, 30)))),
    ]
    return (
        spark.createDataFrame([(base, home)], "url string, html string"),
        spark.createDataFrame(listings, "category string, page int, url string, html string"),
        spark.createDataFrame(list(books_.items()), "url string, html string"),
    )


def test_books_end_to_end(spark, shop, tmp_path):
    home, listings, pages = shop
    run = books.run(home, listings, pages)
    assert run.ready and run.delivered.count() == 30
    one = run.delivered.filter("title = 'Book 3'").first()
    assert (one["upc"], str(one["price_gbp"]), one["in_stock"], one["rating"], one["reviews"], one["category"], one["description"]) == (f"{3:016x}", "51.77", 22, 3, 0, "Travel", "About Book 3.")
    assert books.publish(run, f"file://{tmp_path}/out", 1.0) and "# books: READY" in open(f"{tmp_path}/out/qa_report.md").read()
    # a page unread, a listing missing, a book that strayed, a price that doesn't read
    status = lambda r: {x["name"]: x["status"] for x in r.checks.collect()}
    some = books.run(home, listings, pages.filter("not url like '%/7/%'"))
    assert not some.ready and status(some)["book pages read"] == "FAIL" and status(some)["coverage"] == "FAIL"
    gone = status(books.run(home, listings.filter("category != 'Travel' or page = 1"), pages))
    assert gone["listing pages fetched"] == "FAIL" and gone["category coverage"] == "FAIL"
    odd = pages.filter("not url like '%/28/%'").unionByName(spark.createDataFrame([("http://b/book/28/index.html", _book(f"{28:016x}", "Book 28", "Travel", "free"))], pages.schema))
    wrong = books.run(home, listings, odd)
    assert status(wrong)["category agrees with breadcrumb"] == "FAIL" and status(wrong)["schema"] == "FAIL" and wrong.errors.count() == 1
    assert not books.publish(wrong, f"file://{tmp_path}/out") and "NOT READY" in open(f"{tmp_path}/out/qa_report.md").read()
    # a run that resumes reads only what is left; a partial run doesn't check coverage
    again = books.run(home, listings, pages.filter("url like '%/7/%'"), some.delivered)
    assert again.ready and again.delivered.count() == 30
    part = books.run(home, listings, pages, categories=1)
    assert part.ready and part.delivered.count() == 25 and "coverage" not in status(part)


def test_command_line(spark, shop, tmp_path, monkeypatch):
    folder, out = f"{tmp_path}/saved", f"file://{tmp_path}/out"
    for name, df in zip(("home", "listings", "pages"), shop):
        df.write.parquet(f"{folder}/{name}")
    assert cli.main(["books", "--saved", folder, "--out", out]) == 0
    assert spark.read.parquet(sinks.current(spark, out) + "/books").count() == 30
    shop[2].filter("not url like '%/7/%'").write.mode("overwrite").parquet(f"{folder}/pages")
    assert cli.main(["books", "--saved", folder, "--out", out]) == 2 and os.path.exists(f"{tmp_path}/out/checkpoint")
    shop[2].filter("url like '%/7/%'").write.mode("overwrite").parquet(f"{folder}/pages")
    assert cli.main(["books", "--saved", folder, "--out", out, "--resume"]) == 0 and not os.path.exists(f"{tmp_path}/out/checkpoint")
    block = '<div class="quote"><span class="text">“Be kind.”</span><small class="author">A B</small><a class="tag">y</a></div>'
    spark.createDataFrame([("http://q/", 200, block)], "url string, status int, html string").write.parquet(f"{folder}/blocks")
    assert cli.main(["quotes", "--saved", folder, "--out", f"{out}q", "--no-browser"]) == 0
    assert "| blocks | 1 |" in open(f"{tmp_path}/outq/strategies.md").read()
    spark.createDataFrame([("http://q/", 403, "<title>Attention Required!</title>")], "url string, status int, html string").write.mode("overwrite").parquet(f"{folder}/blocks")
    assert cli.main(["quotes", "--saved", folder, "--out", f"{out}q"]) == 3
    jobs_ = json.dumps({"jobs": [{"id": i, "title": f"Dev {i}", "absolute_url": "http://g", "location": {"name": "Lima, Peru"}, "first_published": "2026-01-02T00:00:00Z", "content": "3+ years of experience."} for i in range(3)]})
    open(f"{folder}/boards.json", "w").write(json.dumps([{"company": "G", "source": "greenhouse", "board": "g"}]))
    spark.createDataFrame([("greenhouse", "g", 200, jobs_)], "source string, board string, status int, body string").write.parquet(f"{folder}/responses")
    monkeypatch.delenv("TIDEMILL_EXTRACTOR", raising=False)
    run = ["jobs", "--saved", folder, "--out", f"{out}j", "--day", "2026-01-03"]
    assert cli.main(run) == 0 and cli.main(run) == 0
    log = open(f"{tmp_path}/outj/CHANGELOG.md").read()
    assert "first snapshot: 3 postings" in log and "+0 new" in log
    told = json.load(open(f"{tmp_path}/outj/qa_report.json"))
    assert told["verdict"] == "READY" and told["rows_delivered"] == 3 and any("min_years 1" in n for n in told["notes"])
    assert cli.main(["query", "qa_gate", SF, f"{tmp_path}/gate"]) == (0 if spark.read.parquet(f"{tmp_path}/gate").first()["verdict"] == "READY" else 2)


def test_upsert_merges_repeated_incoming_keys(spark):
    target = spark.createDataFrame([("1", "a", "x"), ("2", "b", "")], "k string, v string, note string")
    rows = spark.createDataFrame([("1", "c", "", 1), ("1", "d", "n", 2), ("1", "", "", 3), ("4", "e", "", 1), ("4", "", "m", 2)], "k string, v string, note string, _order int")
    got = {r["k"]: (r["v"], r["note"], r["_change"]) for r in upserts.upsert(target, rows, "k").collect()}
    assert got == {"1": ("d", "n", "updated"), "2": ("b", "", "kept"), "4": ("e", "m", "inserted")} and upserts.upsert(target, rows, "k").count() == 3


def test_host_scans_equal_a_loop(spark):
    import random

    rng = random.Random(3)
    rows = [(i, "hot" if rng.random() < 0.7 else f"h{rng.randint(0, 5)}", rng.randint(0, 400), rng.random() < 0.01) for i in range(900)]
    df = spark.createDataFrame(rows, "i int, host string, at int, bad boolean").repartition(5)
    last, blocked, want = {}, set(), {}
    for i, h, at, bad in rows:
        slot = at if h not in last else max(at, last[h] + 3)
        want[i] = (slot, h in blocked)
        last[h] = slot
        if bad:
            blocked.add(h)
    got = {r["i"]: (r["slot"], r["fails_fast"]) for r in fetchlog.blocked_before(fetchlog.paced(df, "host", "i", F.col("at"), F.lit(3)), "host", "i", F.col("bad")).collect()}
    assert got == want and fetchlog.paced(df.limit(0), "host", "i", F.col("at"), F.lit(3)).count() == 0


def test_robots_and_retry_after(spark):
    urls = spark.createDataFrame([("http://a/x/1",), ("http://a/y",), ("http://b/x",), ("http://c/x",), ("http://d/x",)], "url string")
    robots = spark.createDataFrame([("http://a", 200, "User-agent: *\nDisallow: /x/\nCrawl-delay: 2"), ("http://b", 404, None), ("http://c", None, None)], "origin string, status int, body string")
    got = {r["url"]: (r["allowed"], r["interval"]) for r in fetchlog.permitted(urls, "url", robots, "bot", 4.0).collect()}
    assert got == {"http://a/x/1": (False, 2.0), "http://a/y": (True, 2.0), "http://b/x": (True, 0.25), "http://c/x": (False, 0.25), "http://d/x": (True, 0.25)}
    now = F.lit("2026-01-01 00:00:00").cast("timestamp")
    assert values(spark, "string", ["7", "Thu, 01 Jan 2026 00:01:30 GMT", "soon"], fetchlog.told_delay(F.col("x"), now)) == [7.0, 90.0, None]


class Site:
    """Answers of a made-up site, and a clock that only sleeping moves."""

    def __init__(self, pages, robots=(404, "")):
        self.pages, self.robots, self.now, self.log = pages, robots, 0.0, []

    def __call__(self, request):
        self.log.append((self.now, request))
        if request.url.endswith("/robots.txt"):
            return fetch.Answer(self.robots[0], {}, self.robots[1].encode())
        told = self.pages[request.url]
        status, body, *more = told.pop(0) if isinstance(told, list) else told(request) if callable(told) else told
        if status is None:
            raise OSError("down")
        return fetch.Answer(status, more[0] if more else {}, body.encode())

    def session(self, **manners):
        return fetch.Session(fetch.Manners(**manners), self, lambda: self.now, lambda s: setattr(self, "now", self.now + s), lambda: 0.5)


def test_session_paces_retries_and_stops():
    site = Site({"http://a/1": [(200, "one")], "http://a/2": [(503, "x", {"retry-after": "7"}), (None, ""), (200, "two")], "http://a/no/3": [(200, "")], "http://a/4": [(500, "")] * 5, "http://a/5": [(404, "gone")], "http://a/6": [(403, "<h1>Attention Required!</h1>")]}, (200, "User-agent: *\nCrawl-delay: 2\nDisallow: /no/"))
    s = site.session()
    assert s.get("http://a/1").text == "one" and s.get("http://a/2").text == "two"
    times = [t for t, _ in site.log]
    assert times[:3] == [0.0, 0.125, 2.125] and times[3] == 9.125 and times[4] == 11.125
    with pytest.raises(fetch.Forbidden):
        s.get("http://a/no/3")
    for url in ("http://a/4", "http://a/5"):
        with pytest.raises(fetch.Failed):
            s.get(url)
    for _ in range(2):
        with pytest.raises(fetch.Blocked):
            s.get("http://a/6")
    assert s.stats | {"bytes_received": 0} == {"requests": 11, "robots_requests": 1, "retries": 6, "failures": 2, "bytes_received": 0}
    down = Site({}, (500, ""))
    with pytest.raises(fetch.Forbidden):
        down.session(retries=0).get("http://a/1")


def test_login_and_postbacks():
    def login(request):
        if request.method == "GET":
            return 200, '<form action="/in"><input type="hidden" name="csrf_token" value="t0"><input name="user"></form>', {"set-cookie": "sid=1; Path=/"}
        return 200, "?"

    site = Site({"http://a/login": login, "http://a/in": lambda r: (200, "in" if b"csrf_token=t0" in r.body and b"user=me" in r.body and r.headers["Cookie"] == "sid=1" else "out")})
    assert site.session().login("http://a/login", {"user": "me"}).text == "in"

    def search(request):
        form = lambda state, tags, more="": f'<form><input type="hidden" name="__VIEWSTATE" value="{state}"/><select id="author"><option value="">-</option><option value="A">A</option></select><select id="tag">{tags}</select></form>{more}'
        if request.method == "GET":
            return 200, form("s0", "")
        if b"tag=" not in request.body:
            return 200, form("s1", '<option value="x">x</option><option value="y">y</option>')
        assert b"__VIEWSTATE=s1" in request.body
        return 200, form("s2", "", "found " + request.body.decode().rsplit("=", 1)[1])

    found = list(fetch.postbacks(Site({"http://q/s": search}).session(), "http://q/s", "author", "tag"))
    assert [(a, b, page[-7:]) for a, b, page in found] == [("A", "x", "found x"), ("A", "y", "found y")]


def test_requests_of_many_hosts(spark):
    def answer(request):
        if request.url.endswith("robots.txt"):
            return fetch.Answer(404, {}, b"")
        if "//h3" in request.url:
            return fetch.Answer(403, {}, b"captcha")
        return fetch.Answer(200, {}, (request.url + (request.body or b"").decode()).encode())

    rows = [(i, f"http://h{i % 5}/p{i}", {"k": "v"} if i % 2 else None) for i in range(40)]
    got = fetch.fetched(spark.createDataFrame(rows, "n int, url string, values map<string,string>"), transport=answer, clock=lambda: 0.0, sleep=lambda s: None).collect()
    assert {r["n"]: (r["status"], r["body"], r["outcome"]) for r in got} == {i: (None, None, "blocked") if i % 5 == 3 else (200, u + ("k=v" if v else ""), "ok") for i, u, v in rows}
    assert sum(r["attempts"] for r in got if r["outcome"] == "blocked") == 1


def test_streaming(spark, tmp_path):
    kind = "k int, v string, at timestamp"
    for n, rows in enumerate([[(1, "a"), (2, "b")], [(2, "c"), (3, "d")]]):
        spark.createDataFrame([(k, v, dt.datetime(2026, 1, 1, n)) for k, v in rows], kind).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        for f in glob.glob(f"{tmp_path}/in/{n}/part*"):
            os.makedirs(f"{tmp_path}/src", exist_ok=True)
            os.rename(f, f"{tmp_path}/src/{n}.parquet")
            os.utime(f"{tmp_path}/src/{n}.parquet", (n + 1, n + 1))
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/src")
    incremental.snapshot_diffs(stream, f"{tmp_path}/snap", f"{tmp_path}/diff", ["k"], ["v"], f"{tmp_path}/cp").awaitTermination(120)
    got = {(r["batch"], r["k"], r["change"]) for r in spark.read.parquet(f"{tmp_path}/diff").collect()}
    assert got == {(0, 1, "new"), (0, 2, "new"), (1, 1, "closed"), (1, 2, "changed"), (1, 3, "new")}


def test_streaming_dedup_and_counts(spark, tmp_path):
    kind = "k int, v string, at timestamp, status int"
    rows = [(i % 7, f"v{i}", dt.datetime(2026, 1, 1, i % 4, 30), 200 if i % 3 else 503) for i in range(40)]
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{tmp_path}/src")
    stream = spark.readStream.schema(kind).parquet(f"{tmp_path}/src")
    incremental.keep_first(stream, ["k"], "at", "9 hours").writeStream.format("memory").queryName("firsts").trigger(availableNow=True).start().awaitTermination(120)
    got = spark.table("firsts").collect()
    assert sorted(r["k"] for r in got) == list(range(7)) and all((r["k"], r["v"], r["at"], r["status"]) in rows for r in got)
    counts = incremental.status_counts(stream, "at", "status", "1 hour", "1 hour").writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True)
    counts.start().awaitTermination(120)
    want = {}
    for _, _, at, status in rows:
        want[at.hour, status] = want.get((at.hour, status), 0) + 1
    assert {(r["window"]["start"].hour, r["status"]): r["n"] for r in spark.table("counts").collect()} == want


def test_walk_has_no_limit_and_cuts_cycles(spark):
    chain = [(f"c{i}", f"c{i + 1}") for i in range(10_500)]
    rows = [*chain, ("a", "b"), ("b", "c"), ("c", "b"), ("s", "s"), ("x", "c"), ("end", None), ("gone", "nowhere"), (None, "a"), ("far", "a"), ("d", "e"), ("d", "e"), ("e", "f"), ("f", "g"), ("m", "n"), ("m", "end")]
    starts = ["c0", "a", "s", "x", "gone", "d", "m", "unknown", None, "a"]
    got = ingest.walk(spark.createDataFrame(rows, "url string, next_url string"), spark.createDataFrame([(s,) for s in starts], "url string"))
    want = []
    for s in {s for s in starts if s is not None}:
        step, now, seen = 0, [s], set()
        while now:
            pages = [r for r in rows if r[0] in now] if s != "c0" else chain[step : step + 1]
            want += [(r[0], step) for r in pages]
            seen |= {r[0] for r in pages}
            now, step = [r[1] for r in pages if r[1] is not None and r[1] not in seen], step + 1
    assert sorted(tuple(r) for r in got.select("url", "step").collect()) == sorted(want)
