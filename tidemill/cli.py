"""python -m tidemill.cli books | quotes | jobs | query: runs a pipeline over saved payloads, or a registered query.

Exit code 0: the gate says READY; 2: NOT READY; 3: a saved answer is an anti-bot challenge, and nothing was done.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill import registry
from tidemill.operators import extraction, fetchlog
from tidemill.plans import books, jobs, quotes
from tidemill.sources import files, ingest, parsers, sinks


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    sub = parser.add_subparsers(dest="case", required=True)

    def case(name: str, told: str) -> argparse.ArgumentParser:
        own = sub.add_parser(name, help=told)
        own.add_argument("--saved", required=True, help="folder with the saved payloads, as Parquet tables")
        own.add_argument("--out", required=True, help="folder of the published versions and the report")
        return own

    own = case("books", "home, listings and pages to books")
    own.add_argument("--resume", action="store_true", help="continue from the checkpoint of a run that did not go through")
    own.add_argument("--max-categories", type=int, help="a partial run over the first categories")
    own = case("quotes", "blocks, scripts, api, tables and searches to quotes")
    own.add_argument("--no-browser", action="store_true", help="without the payloads that a browser saved")
    own = case("jobs", "boards and their answers to postings")
    own.add_argument("--boards", help="JSON list of company, source, board (default: boards.json among the saved payloads)")
    own.add_argument("--sheet", help="Parquet table of sheet cells to upsert the families into")
    own.add_argument("--no-extractor", action="store_true", help="rules only")
    own.add_argument("--day", type=dt.date.fromisoformat, help="the day that the changelog names (default: today)")
    own = sub.add_parser("query", help="a registered query, written as Parquet")
    own.add_argument("name", choices=sorted(registry.QUERIES))
    own.add_argument("sf_dir")
    own.add_argument("out")
    return parser


def saved(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    path = f"{folder}/{name}"
    return spark.read.parquet(path) if files.exists(spark, path) else None


def challenged(answers: list[DataFrame | None]) -> bool:
    """Whether a saved answer (status, and body or html) is a challenge page."""
    for df in answers:
        if df is not None and "status" in df.columns:
            body = F.col("body" if "body" in df.columns else "html")
            if not df.filter(fetchlog.looks_blocked(F.col("status"), body)).isEmpty():
                return True
    return False


def run_books(spark: SparkSession, args: argparse.Namespace) -> bool | None:
    home, listings, pages = (saved(spark, args.saved, n) for n in ("home", "listings", "pages"))
    if challenged([home, listings, pages]):
        return None
    began, checkpoint = time.perf_counter(), f"{args.out}/checkpoint"
    if not args.resume:
        sinks.remove_checkpoint(spark, checkpoint)
    run = books.run(home, listings, pages, saved(spark, args.out, "checkpoint"), args.max_categories)
    books.publish(run, args.out, time.perf_counter() - began)
    sinks.remove_checkpoint(spark, checkpoint)
    if not run.ready:
        sinks.add_checkpoint(run.delivered, checkpoint)
    return run.ready


def run_quotes(spark: SparkSession, args: argparse.Namespace) -> bool | None:
    kinds = {"blocks": parsers.quotes_of_blocks, "scripts": parsers.quotes_of_scripts, "api": parsers.quotes_of_api, "tables": parsers.quotes_of_tables, "searches": parsers.quotes_of_searches, "browser": parsers.quotes_of_blocks}
    pages = {n: None if n == "browser" and args.no_browser else saved(spark, args.saved, n) for n in kinds}
    if challenged(list(pages.values())):
        return None
    began = time.perf_counter()
    routes = {n: None if df is None else (lambda df=df, read=kinds[n]: read(df).select("text", "author", "tags")) for n, df in pages.items()}
    run = quotes.run(routes, ("searches",), {n: df.count() for n, df in pages.items() if df is not None})
    quotes.publish(run, args.out, time.perf_counter() - began)
    return run.ready


def run_jobs(spark: SparkSession, args: argparse.Namespace) -> bool | None:
    answers = saved(spark, args.saved, "responses")
    if challenged([answers]):
        return None
    began = time.perf_counter()
    boards, previous = ingest.boards(spark, args.boards or f"{args.saved}/boards.json"), jobs.last_snapshot(spark, args.out)
    extractor, calls = (None if args.no_extractor else extraction.from_environment()) or (None, jobs.CALLS)
    run = jobs.run(boards, answers, previous, extractor, calls)
    jobs.publish(run, args.out, previous, args.day or dt.date.today(), time.perf_counter() - began, spark.read.parquet(args.sheet) if args.sheet else None)
    return run.ready


def run_query(spark: SparkSession, args: argparse.Namespace) -> bool:
    rows = registry.QUERIES[args.name](spark, args.sf_dir)
    rows.write.mode("overwrite").parquet(args.out)
    return "verdict" not in rows.columns or spark.read.parquet(args.out).filter("verdict = 'NOT READY'").isEmpty()


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ready = {"books": run_books, "quotes": run_quotes, "jobs": run_jobs, "query": run_query}[args.case](spark, args)
    if ready is None:
        print("stopped: a saved answer is an anti-bot challenge", file=sys.stderr)
        return 3
    return 0 if ready else 2


if __name__ == "__main__":
    raise SystemExit(main())
