"""The hierarchy pipeline: home page, listings and book pages (all saved) to gated books."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import text
from tidemill.operators import contracts
from tidemill.sources import ingest, parsers, sinks
from tidemill.sources.files import kept

PAGE = 20
# How many items the report shows of what each check found.
SHOWN = {"schema": 25, "unique key": 3, "category coverage": 10, "listing pages fetched": 8, "listing page yield": 8, "category agrees with breadcrumb": 3, "book pages read": 20}


def spec(expected: int | None) -> contracts.Spec:
    c = F.col
    return contracts.Spec(
        "books",
        ("upc",),
        {
            "upc: not 16 hex digits": F.coalesce(c("upc").rlike("^[0-9a-f]{16}$"), F.lit(False)),
            "title: empty": F.length("title") > 0,
            "category: empty": F.length("category") > 0,
            "price_gbp: missing or below 0": F.coalesce(c("price_gbp") >= 0, F.lit(False)),
            "price_excl_tax_gbp: missing or below 0": F.coalesce(c("price_excl_tax_gbp") >= 0, F.lit(False)),
            "tax_gbp: missing or below 0": F.coalesce(c("tax_gbp") >= 0, F.lit(False)),
            "in_stock: missing or below 0": F.coalesce(c("in_stock") >= 0, F.lit(False)),
            "rating: not 1 to 5": F.coalesce(c("rating").between(1, 5), F.lit(False)),
            "reviews: missing or below 0": F.coalesce(c("reviews") >= 0, F.lit(False)),
            "prices do not add up": c("price_excl_tax_gbp") + c("tax_gbp") == c("price_gbp"),
        },
        expected,
        1.0,
        {"description": 0.95},
    )


@dataclass
class Run:
    delivered: DataFrame
    checks: DataFrame
    errors: DataFrame
    rows_in: int
    ready: bool
    samples: DataFrame


def run(home: DataFrame, listings: DataFrame, pages: DataFrame, done: DataFrame | None = None, categories: int | None = None) -> Run:
    """home: url, html; listings: category, page, url, html; pages: url, html.

    done: books of an earlier run (a checkpoint); their pages are not read again. categories: a partial run over the first
    ones of the home page; coverage is then not checked.
    """
    total = home.select(text.first_int(parsers.declared_count("html", "url"))).first()[0]
    named = home.select(F.posexplode(parsers.home_categories("html", "url")).alias("pos", "c")).select("pos", "c.category")
    if categories is not None:
        total = None
        listings = listings.join(F.broadcast(ingest.first_categories(named, categories).select("category")), "category", "left_semi")
    # each page is parsed once, for all that is asked of it below
    seen = listings.withColumn("p", parsers.listing_page("html", "url"))
    listed = kept(seen.select("category", "page", "p.links", F.col("p.next").isNotNull().alias("has_next"), text.first_int(F.col("p.declared")).alias("declared")), "listings")
    links = listed.select("category", F.col("page").alias("listing_no"), F.posexplode("links").alias("pos", "url"))
    firsts = ingest.first_listing(links)
    todo = firsts if done is None else ingest.remaining(firsts, done, "url")
    rows = parsers.books(pages.join(todo.select("url"), "url", "left_semi"))
    if done is not None:
        rows = rows.unionByName(done.join(firsts.select("url"), "url", "left_semi").select(*rows.columns))
    rows = kept(rows)
    declared = listed.groupBy("category").agg(F.max("declared").alias("declared"))
    where = F.concat_ws(" page ", "listing", "page")
    short = contracts.group_coverage(links, declared, "category").filter("not complete")
    gaps = ingest.page_gaps(listed.select(F.col("category").alias("listing"), "page", "has_next"))
    odd = contracts.page_yield(listed.select(F.col("category").alias("listing"), "page", F.size("links").alias("n")), PAGE)
    told = firsts.join(rows.select("url", F.nullif("category", F.lit("")).alias("told")), "url", "left")
    read = firsts.join(rows.select("url", F.lit(True).alias("read")), "url", "left")
    rules, order = spec(total), [F.col("url")]
    checked = contracts.validated(rows, rules)
    errors = contracts.row_errors(checked, F.col("url"), ("upc",))
    found = [
        contracts.found(errors, "schema", F.concat_ws(": ", "key", "errors"), F.col("row_order")),
        contracts.found(contracts.repeated(checked, ("upc",)), "unique key", F.col("key"), F.col("key")),
        contracts.found(short, "category coverage", F.format_string("%s (%d/%d)", "category", "listed", "declared"), F.col("category")),
        contracts.found(gaps, "listing pages fetched", where, where),
        contracts.found(odd, "listing page yield", F.format_string("%s page %d (%d)", "listing", "page", "n"), where),
        contracts.found(told.filter("told <> category"), "category agrees with breadcrumb", F.col("url"), F.col("url")),
        contracts.found(read.filter("read is null"), "book pages read", F.col("url"), F.col("url")),
    ]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    samples = kept(contracts.samples(every, SHOWN))
    n = {r["check"]: r["n"] for r in samples.select("check", "n").collect()}
    short, gaps, odd, strayed, unread = (n.get(k, 0) for k in list(SHOWN)[2:])
    missing = 0 if categories is not None else named.join(listed.select("category"), "category", "left_anti").count()
    facts = (
        ("category coverage", short == 0 and missing == 0, f"{short} short, {missing} without a listing"),
        ("listing pages fetched", gaps == 0, f"{gaps} missing"),
        ("listing page yield", odd == 0, f"{odd} odd"),
        ("category agrees with breadcrumb", strayed == 0, f"{strayed} differ"),
        ("book pages read", unread == 0, f"{unread} unread"),
    )
    extra = rows.sparkSession.createDataFrame([(n, ok, detail, True) for n, ok, detail in facts], "name string, passed boolean, detail string, blocking boolean")
    checks = kept(contracts.gate(rows, rules, order, extra))
    delivered = contracts.numbered(checked, rules, order).filter("_n = 1").drop("_n", "_errors")
    return Run(delivered, checks, errors, rows.count(), checks.filter("status = 'FAIL'").isEmpty(), samples)


def publish(run_: Run, final: str, elapsed: float | None = None) -> str | None:
    """Books as Parquet, CSV and JSON lines, and the report; nothing is replaced unless the gate lets the run through."""
    spark, rows = run_.delivered.sparkSession, run_.delivered.orderBy("category", "title", "upc")
    outputs = {"books": lambda p: rows.write.parquet(p), "books_csv": lambda p: sinks.write_csv(rows, p), "books_jsonl": lambda p: sinks.write_jsonl(rows, p)}
    version = sinks.publish(spark, run_.ready, outputs, final)
    fills = contracts.fill_rates(run_.delivered, run_.delivered.columns)
    sinks.write_report(spark, sinks.report("books", run_.checks, run_.errors, fills, run_.rows_in, run_.delivered.count(), elapsed=elapsed, samples=run_.samples), final)
    return version
