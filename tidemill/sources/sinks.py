"""Sinks: CSV, JSON lines, JSON documents, reports, changelog, and publishing behind the gate."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.text import csv_cell, sheet_cell
from tidemill.sources import files

CHANGELOG = "# What changed\n\nThe latest run comes first.\n\n"
#: Errors that a report shows.
SHOWN = 25


def cells(rows: DataFrame, columns: list[str] | None = None, sheet: bool = False) -> DataFrame:
    """rows as strings, ready for CSV or a sheet."""
    kinds, encode = dict(rows.dtypes), sheet_cell if sheet else csv_cell
    return rows.select(*(encode(F.col(c), kinds[c]).alias(c) for c in columns or rows.columns))


def write_csv(rows: DataFrame, path: str, columns: list[str] | None = None) -> None:
    cells(rows, columns).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def json_safe(rows: DataFrame) -> DataFrame:
    """Decimals as strings, dates as ISO, in the order of the fields."""
    return rows.select(*(F.col(c).cast("string").alias(c) if kind.startswith("decimal") else F.col(c) for c, kind in rows.dtypes))


def write_jsonl(rows: DataFrame, path: str) -> None:
    json_safe(rows).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_json(spark: SparkSession, data, path: str) -> None:
    files.write_text(spark, path, json.dumps(data, ensure_ascii=False, indent=2, default=str) + "\n")


def report(name: str, checks: DataFrame, errors: DataFrame, fills: DataFrame, rows_in: int, delivered: int, stats: dict | None = None, notes: tuple[str, ...] = (), elapsed: float | None = None, samples: DataFrame | None = None) -> dict:
    """Of a run: verdict, rows in and delivered, checks (with samples of what they found), the first errors by row, fill rates,
    fetch statistics, seconds, notes.

    checks and fills are small tables (a row for each check or field); of errors (row_order, key, errors) SHOWN rows are read.
    """
    told = [c.asDict() for c in checks.collect()]
    shown = {} if samples is None else {r["check"]: r["shown"] for r in samples.select("check", "shown").collect()}
    ready = all(c["passed"] or not c["blocking"] for c in told)
    first = [e.asDict() for e in errors.orderBy("row_order").limit(SHOWN).collect()]
    return {
        "dataset": name, "verdict": "READY" if ready else "NOT READY", "rows_in": rows_in, "rows_delivered": delivered,
        "checks": [{k: c[k] for k in ("name", "passed", "detail", "blocking")} | ({"shown": shown[c["name"]]} if c["name"] in shown else {}) for c in told], "errors": first,
        "fill_rates": {f["field"]: f["fill_rate"] for f in fills.collect()}, "fetch": stats, "elapsed_s": None if elapsed is None else round(elapsed, 2), "notes": list(notes),
    }


def markdown(told: dict) -> str:
    lines = [f"# {told['dataset']}: {told['verdict']}", "", f"{told['rows_delivered']} of {told['rows_in']} rows delivered" + (f" in {told['elapsed_s']} s" if told["elapsed_s"] is not None else ""), "", "| check | status | detail |", "|---|---|---|"]
    lines += [f"| {c['name']} | {'PASS' if c['passed'] else 'FAIL' if c['blocking'] else 'WARN'} | {c['detail']}{'; e.g. ' + ', '.join(c['shown']) if c.get('shown') else ''} |" for c in told["checks"]]
    if told["fill_rates"]:
        lines += ["", "| field | filled |", "|---|---|", *(f"| {k} | {v * 100:.1f} % |" for k, v in told["fill_rates"].items())]
    if told["errors"]:
        lines += ["", "## Errors", "", *(f"- {e['key']}: {e['errors']}" for e in told["errors"])]
    if told["fetch"]:
        lines += ["", "## Requests", "", *(f"- {k}: {v}" for k, v in told["fetch"].items())]
    lines += ["", *(f"- {n}" for n in told["notes"])] if told["notes"] else []
    return "\n".join(lines) + "\n"


def strategies(results: list[dict]) -> str:
    """A table that compares routes: name, rows, seconds, requests, status."""
    lines = ["| route | rows | seconds | requests | status |", "|---|---|---|---|---|"]
    return "\n".join([*lines, *(f"| {r['name']} | {r['rows']} | {r['seconds']:.1f} | {r['requests']} | {r['status']} |" for r in results)]) + "\n"


def write_report(spark: SparkSession, told: dict, folder: str) -> None:
    write_json(spark, told, f"{folder}/qa_report.json")
    files.write_text(spark, f"{folder}/qa_report.md", markdown(told))


def prepend_changelog(spark: SparkSession, path: str, entry: str) -> None:
    old = files.read_text(spark, path) or CHANGELOG
    files.write_text(spark, path, CHANGELOG + entry + "\n" + old.removeprefix(CHANGELOG))


CURRENT = "CURRENT"


def current(spark: SparkSession, final: str) -> str | None:
    """The folder of the version that is published, if any."""
    name = files.read_text(spark, f"{final}/{CURRENT}")
    return f"{final}/{name.strip()}" if name else None


def publish(spark: SparkSession, ready: bool, outputs: dict[str, Callable[[str], None]], final: str, keep: int = 2) -> str | None:
    """Writes all outputs (name to a function that writes to a path) as a new version below final, if the gate is passed.

    A version's folder is written whole before the file CURRENT names it; that file is replaced by one rename, so readers
    see the old version or the new one on any file system that Spark writes to. The last `keep` versions stay.
    """
    if not ready:
        return None
    known = [n for n in files.names(spark, final) if n.startswith("v")]
    name = f"v{max([int(n[1:]) for n in known], default=0) + 1:06d}"
    files.delete(spark, f"{final}/{name}")
    for output, write in outputs.items():
        write(f"{final}/{name}/{output}")
    files.write_text(spark, f"{final}/{CURRENT}", name)
    for old in sorted(known)[: max(0, len(known) + 1 - keep)]:
        files.delete(spark, f"{final}/{old}")
    return f"{final}/{name}"


def add_checkpoint(rows: DataFrame, path: str) -> None:
    """Appends done rows (key, value) to a checkpoint; ingest.remaining() skips them in a run that resumes."""
    rows.write.mode("append").parquet(path)


def remove_checkpoint(spark: SparkSession, path: str) -> None:
    """After a run that went through."""
    files.delete(spark, path)
