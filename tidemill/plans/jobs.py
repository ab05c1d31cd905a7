"""The snapshot pipeline: board answers to gated postings, with families, diff and changelog."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import text
from tidemill.operators import contracts, extraction, snapshots, upserts
from tidemill.sources import ingest, parsers, sinks
from tidemill.sources.files import kept

POSTING = (
    "key string, source string, company string, posting_id string, title string, url string, location string, countries array<string>, remote boolean, open_to_colombia boolean,"
    " employment_type string, published date, family_id string, description_sha1 string, min_years int, english_level string, pay_usd_hour_max double, pay_usd_year_max double,"
    " hours_per_week string, evidence map<string,string>, extracted_by map<string,string>"
)
Extractor = Callable[[str, list[str]], dict[str, tuple[str, str]]]
#: Descriptions that one run asks an extractor about, unless a caller says otherwise.
CALLS = 40
#: Boards that the notes list.
SHOWN = 50
# How many items the report shows of what each check found.
SAMPLES = {"schema": 25, "unique key": 3, "fetch failures": 8, "every board answered": 20, "no board went silent": 20, "evidence is verbatim": 3}
COLUMNS = tuple(c.split()[0] for c in POSTING.split(", "))


def spec(expected: int | None = None) -> contracts.Spec:
    c = F.col
    return contracts.Spec(
        "postings",
        ("key",),
        {
            "source: unknown": c("source").isin(*parsers.ENDPOINTS),
            "title: empty": F.length("title") > 0,
            "countries: not ISO codes": F.forall("countries", lambda x: x.rlike("^[A-Z]{2}$")),
            "family_id: not 12 hex digits": c("family_id").rlike("^[0-9a-f]{12}$"),
            "description_sha1: not 40 hex digits": c("description_sha1").rlike("^[0-9a-f]{40}$"),
            "min_years: not 0 to 30": c("min_years").between(0, 30),
            "pay_usd_hour_max: not between 0 and 1000": (c("pay_usd_hour_max") > 0) & (c("pay_usd_hour_max") < 1000),
            "pay_usd_year_max: not above 0": c("pay_usd_year_max") > 0,
        },
        expected,
    )


@dataclass
class Run:
    delivered: DataFrame
    checks: DataFrame
    families: DataFrame
    diff: DataFrame
    failed: DataFrame
    ready: bool
    errors: DataFrame
    rows_in: int
    notes: tuple[str, ...]
    samples: DataFrame

    def changelog(self, day: dt.date, previous: DataFrame, first_run: bool) -> str:
        own = {k: (previous if k == "closed" else self.delivered).join(self.diff.filter(F.col("change") == k), "key", "left_semi") for k in ("new", "closed", "changed")}
        return snapshots.changelog_entry(day, self.delivered, own, "key", first_run)


def fresh(boards: DataFrame, extractor: Extractor | None = None, calls: int = CALLS) -> tuple[DataFrame, extraction.Answers | None]:
    """Postings of all answered boards (with bodies), enriched once for each distinct description, evidence checked.

    An extractor, if given, is asked about fields that the rules left empty and the text hints at, for so many
    descriptions at most: first those open to Colombia, then the unclear ones. Its answers come back too.
    """
    # read twice below, for each posting and for each description: boards are parsed once, by one Python worker in a task
    raw = kept(parsers.postings(boards).withColumn("family_id", text.family_id(F.col("company"), F.col("title"))), "parsed")
    rows = extraction.enriched(raw.withColumn("_body", F.col("description")), "description", "key")
    told = None
    if extractor is not None:
        rows, open_to = kept(rows), F.col("open_to_colombia")
        rank = F.when(open_to, 0).when(open_to.isNull(), 1).otherwise(2)
        told = extraction.asked(rows, "_body", rank, "key", extractor, calls)
    rows = extraction.merged(rows, told.accepted if told else None)
    bad = F.lit(False)
    for f in extraction.FIELDS:
        bad = bad | (F.col(f"{f}_evidence").isNotNull() & ~extraction.supported(F.col("_body"), F.col(f"{f}_evidence")))
    pairs = lambda value: F.map_filter(F.create_map(*[x for f in extraction.FIELDS for x in (F.lit(f), value(f))]), lambda k, v: v.isNotNull())
    evidence = pairs(lambda f: F.col(f"{f}_evidence"))
    by = pairs(lambda f: F.col(f"{f}_by"))
    return rows.withColumn("unsupported", bad).withColumns({"evidence": evidence, "extracted_by": by}).select(*COLUMNS, "unsupported"), told


def run(configured: DataFrame, responses: DataFrame, previous: DataFrame, extractor: Extractor | None = None, calls: int = CALLS) -> Run:
    """configured: company, source, board; responses: source, board, status, body; previous: the last snapshot.

    extractor, calls: as in fresh().
    """
    ok, failed = ingest.answered(configured, responses)
    board = lambda df: df.withColumn("board", text.board_of(F.col("key")))
    name = F.concat_ws(":", "source", "board").alias("board")
    now, told = fresh(ok, extractor, calls)
    now = kept(now)
    before, gone = board(previous), failed.select(name)
    current = snapshots.carried(before, board(now.drop("unsupported")), gone, "board")
    quiet = snapshots.silent(before, board(now), gone, configured.select(name), "board")
    rules, order = spec(), [F.col("source"), F.col("posting_id")]
    rows = kept(current.drop("board"))
    checked = contracts.validated(rows, rules)
    errors = contracts.row_errors(checked, F.col("key"), ("key",))
    at = F.concat_ws(":", "source", "board")
    found = contracts.found(errors, "schema", F.concat_ws(": ", "key", "errors"), F.col("row_order"))
    for more in (
        contracts.found(contracts.repeated(checked, ("key",)), "unique key", F.col("key"), F.col("key")),
        contracts.found(failed.filter("reason <> 'body is not JSON'"), "fetch failures", F.concat_ws(": ", at, "reason"), at),
        contracts.found(failed, "every board answered", F.concat_ws(": ", at, "reason"), at),
        contracts.found(quiet, "no board went silent", F.format_string("%s (%d before)", "board", "before"), F.col("board")),
        contracts.found(now.filter("unsupported"), "evidence is verbatim", F.col("key"), F.col("key")),
    ):
        found = found.unionByName(more)
    samples = kept(contracts.samples(found, SAMPLES))
    n = {r["check"]: r["n"] for r in samples.select("check", "n").collect()}
    facts = {
        "fetch failures": ("fetch failures" not in n, False, f"{n.get('fetch failures', 0)} request(s) failed after retries"),
        "every board answered": ("every board answered" not in n, False, ""),
        "no board went silent": ("no board went silent" not in n, True, ""),
        "evidence is verbatim": ("evidence is verbatim" not in n, True, ""),
    }
    known = (F.size("countries") > 0) | F.col("open_to_colombia").isNotNull()
    rate = now.agg(F.coalesce(F.avg(known.cast("double")), F.lit(1.0))).first()[0]
    facts["location resolved"] = (rate >= 0.9, False, f"{rate * 100:.1f} % of the postings")
    extra = now.sparkSession.createDataFrame([(k, bool(v), detail, b) for k, (v, b, detail) in facts.items()], "name string, passed boolean, detail string, blocking boolean")
    checks = kept(contracts.gate(rows, rules, order, extra))
    delivered = kept(contracts.numbered(checked, rules, order).filter("_n = 1").drop("_n", "_errors"))
    diff = kept(snapshots.diff(previous, delivered, ["key"], ["title", "location", "description_sha1"]))
    families = snapshots.families(delivered, "key")
    own = [f"{r['board']} {r['n']}" for r in board(now).groupBy("board").agg(F.count("*").alias("n")).orderBy("board").limit(SHOWN).collect()]
    size = delivered.agg(F.count("*").alias("n"), F.countDistinct("family_id").alias("f"), F.countDistinct("description_sha1").alias("d")).first()
    open_to = {r["flag"]: r["n"] for r in snapshots.histogram(delivered, F.col("open_to_colombia")).collect()}
    hits = [f"{r['field']} {r['n']}" for r in extraction.rule_hits(now.withColumns({f: F.when(F.col("extracted_by")[f] == "rules", F.col(f).cast("string")) for f in extraction.FIELDS})).collect()]
    changed = {r["change"]: r["n"] for r in diff.groupBy("change").agg(F.count("*").alias("n")).collect()}
    notes = [
        f"boards (the first {SHOWN}): " + ", ".join(own),
        f"{size['n']} postings, {size['f']} families, {size['d']} different descriptions",
        f"open to Colombia: {open_to.get(True, 0)} yes, {open_to.get(None, 0)} not stated, {open_to.get(False, 0)} no",
        "read by rules, for each description: " + ", ".join(hits),
        "no extractor" if told is None else f"extractor: {told.calls} calls, {told.accepted.count()} values accepted, {told.rejected.count()} not",
        f"against the last snapshot: {changed.get('new', 0)} new, {changed.get('closed', 0)} closed, {changed.get('changed', 0)} changed",
    ]
    ready = checks.filter("status = 'FAIL'").isEmpty()
    return Run(delivered, checks, families, diff, failed, ready, errors, rows.count(), tuple(notes), samples)


def publish(done: Run, final: str, previous: DataFrame, day: dt.date, elapsed: float | None = None, sheet: DataFrame | None = None) -> str | None:
    """Publishes a run that the gate lets through: snapshot, both CSVs, and the sheet's cells if a sheet is given.

    A version of its own below final; report and changelog lie beside the versions. The report is written in any case. Path of
    the version, or None.
    """
    spark = done.delivered.sparkSession
    ordered = done.families.orderBy("company", "title")
    outputs = {
        "postings": lambda p: done.delivered.write.parquet(p),
        "postings_csv": lambda p: sinks.write_csv(done.delivered, p),
        "families_csv": lambda p: sinks.write_csv(ordered, p),
        "changes": lambda p: snapshots.in_order(done.diff, ["key"]).write.json(p),
    }
    if sheet is not None:
        cells = sinks.cells(done.families, sheet=True)
        outputs["sheet"] = lambda p: upserts.upsert(sheet, cells, "family_id").drop("_change").write.parquet(p)
    entry = done.changelog(day, previous, previous.isEmpty()) if done.ready else None
    version = sinks.publish(spark, done.ready, outputs, final)
    if entry:
        sinks.prepend_changelog(spark, f"{final}/CHANGELOG.md", entry)
    fills = contracts.fill_rates(done.delivered, list(COLUMNS))
    notes = done.notes if version else (*done.notes, "not ready: what was published before stays")
    sinks.write_report(spark, sinks.report("postings", done.checks, done.errors, fills, done.rows_in, done.delivered.count(), None, notes, elapsed, done.samples), final)
    return version


def last_snapshot(spark, final: str) -> DataFrame:
    """The postings that are published, none before the first run."""
    at = sinks.current(spark, final)
    return ingest.snapshot(spark, f"{at}/postings", POSTING) if at else spark.createDataFrame([], POSTING)
