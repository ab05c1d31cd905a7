"""The multi-route pipeline: one dataset by several routes, each held against the first."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators import contracts
from tidemill.sources import files, sinks
from tidemill.sources.files import kept

KEY = ("author", "text")


def spec(expected: int | None = None) -> contracts.Spec:
    return contracts.Spec("quotes", KEY, {"text: empty": F.length("text") > 0, "author: empty": F.length("author") > 0}, expected)


@dataclass
class Route:
    """How one route went: its rows (text, author, tags), or why there are none."""

    name: str
    rows: DataFrame | None
    n: int = 0
    seconds: float = 0.0
    requests: int = 0
    error: str | None = None
    skipped: bool = False


def taken(name: str, source: DataFrame | Callable[[], DataFrame] | None, requests: int = 0) -> Route:
    """A route's rows, read here and now. A route that breaks is reported and breaks no other; None is a skipped one."""
    if source is None:
        return Route(name, None, skipped=True)
    began = time.perf_counter()
    try:
        rows = kept(source() if callable(source) else source)
        return Route(name, rows, rows.count(), time.perf_counter() - began, requests)
    except (PySparkException, ValueError, KeyError) as e:
        return Route(name, None, 0, time.perf_counter() - began, requests, f"{type(e).__name__}: {str(e).splitlines()[0][:200] if str(e) else ''}")


@dataclass
class Run:
    delivered: DataFrame
    checks: DataFrame
    errors: DataFrame
    rows_in: int
    ready: bool
    routes: list[Route]


def run(routes: dict[str, DataFrame | Callable[[], DataFrame] | None], tag_only: tuple[str, ...] = (), requests: dict[str, int] | None = None) -> Run:
    """routes: name to text, author, tags (or a function that gives them); the first is the baseline, None is a skipped route.

    Routes of tag_only find quotes by tag: quotes of the baseline without tags may be missing there. requests: how many a route took.
    """
    done = [taken(name, source, (requests or {}).get(name, 0)) for name, source in routes.items()]
    number = Window.partitionBy(*KEY).orderBy(F.col("tags").cast("string"))
    first, *others = done
    if first.rows is None:
        raise ValueError(f"the baseline route {first.name} gave no rows: {first.error or 'skipped'}")
    base = first.rows.withColumn("_order", F.row_number().over(number))
    untagged = base.filter(F.size("tags") == 0)
    checks = [(f"{first.name} ran clean", first.n > 0, f"{first.n} quotes", True)]
    for route in others:
        if route.rows is None:
            checks.append((f"{route.name} matches {first.name}", False, "skipped" if route.skipped else route.error, not route.skipped))
            continue
        got = route.rows.withColumn("_order", F.row_number().over(number))
        told = contracts.consistency(base, got, list(KEY), "tags", untagged if route.name in tag_only else None).first()
        checks.append((f"{route.name} matches {first.name}", not (told["missing"] or told["extra"] or told["mismatched"] or told["duplicated"]), ", ".join(f"{k} {v}" for k, v in told.asDict().items()), True))
    extra = base.sparkSession.createDataFrame(checks, "name string, passed boolean, detail string, blocking boolean")
    rules, order = spec(), [F.col("tags").cast("string")]
    checked = contracts.validated(first.rows, rules)
    gated = kept(contracts.gate(first.rows, rules, order, extra))
    delivered = contracts.numbered(checked, rules, order).filter("_n = 1").drop("_n", "_errors")
    return Run(delivered, gated, contracts.row_errors(checked, F.col("text"), KEY), first.n, gated.filter("status = 'FAIL'").isEmpty(), done)


def publish(run_: Run, final: str, elapsed: float | None = None) -> str | None:
    """Quotes as CSV and JSON lines, the table that compares the routes, and the report."""
    spark, rows = run_.delivered.sparkSession, run_.delivered.orderBy(*KEY)
    version = sinks.publish(spark, run_.ready, {"quotes_csv": lambda p: sinks.write_csv(rows, p), "quotes_jsonl": lambda p: sinks.write_jsonl(rows, p)}, final)
    told = {r["name"].split(" ")[0]: r["status"] for r in run_.checks.filter(F.col("name").contains(" matches ")).collect()}
    table = [{"name": r.name, "rows": r.n, "seconds": r.seconds, "requests": r.requests, "status": "baseline" if r is run_.routes[0] else told.get(r.name, "")} for r in run_.routes]
    files.write_text(spark, f"{final}/strategies.md", sinks.strategies(table))
    fills = contracts.fill_rates(run_.delivered, run_.delivered.columns)
    sinks.write_report(spark, sinks.report("quotes", run_.checks, run_.errors, fills, run_.rows_in, run_.delivered.count(), elapsed=elapsed), final)
    return version
