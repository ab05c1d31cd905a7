"""Requirement extraction by rules, with the passage that each value was read from as evidence."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import WHITE, clean, clean_folded, scaled
from tidemill.sources.files import kept

# The patterns by which requirements are read, and English levels in order of precedence.
YEARS_RANGE = r"(?iu)\b(\d{1,2})\s*(?:-|–|to)\s*\d{1,2}\s*years?\b[^.\n]{0,80}?\bexperience"
YEARS_LEAST = r"(?iu)\b(\d{1,2})\s*\+?\s*(?:or more\s+)?years?\b[^.\n]{0,80}?\bexperience|\bexperience\b[^.\n]{0,40}?\b(\d{1,2})\s*\+?\s*years?\b"
HOURLY = r"(?iu)(?:\$|US\$\s?|USD\s?)(\d{1,4}(?:\.\d{1,2})?)\s*(?:USD\s*)?(?:/|per|an|a)\s*(?:hour|hr)\b"
YEARLY = r"\$\s?(\d{2,3}(?:,\d{3})+|\d{2,3}[kK])\s*(?:USD\s*)?(?:-|–|—|to)\s*\$?\s?(\d{2,3}(?:,\d{3})+|\d{2,3}[kK])"
HOURS_RANGE = r"(?iu)\b(\d{1,2})\s*(?:-|–|to)\s*(\d{1,2})\s*hours?\s*(?:per|a|/)\s*week"
HOURS_SINGLE = r"(?iu)\b(\d{1,2})\s*\+?\s*hours?\s*(?:per|a|/)\s*week"
CEFR = r"\b([ABC][12])\b"
LEVELS = ("native", "fluent", "proficient", "advanced", "upper-intermediate", "intermediate")
HINTS = {
    "min_years": r"(?i)\byears?\b",
    "english_level": r"(?i)\benglish\b",
    "pay_usd_hour_max": r"(?i)per hour|/\s?hr\b|hourly",
    "pay_usd_year_max": r"(?i)salary|compensation|annual|per year",
    "hours_per_week": r"(?i)hours?\s+(?:per|a|/)\s*week",
}
FIELDS = tuple(HINTS)


def passages(text: Column) -> Column:
    """Lines, split into sentences; trimmed, blank ones dropped."""
    lines = F.split(text, r"\R|[\x1c-\x1e]")
    parts = F.flatten(F.transform(lines, lambda line: F.split(line, r"(?<=[.!?])" + WHITE)))
    return F.filter(F.transform(parts, lambda p: F.regexp_replace(p, f"^{WHITE}|{WHITE}$", "")), lambda p: p != "")


def _group(p: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(p, pattern, group), F.lit(""))


def rules(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, the five fields and their evidence (passage), one row for each row of texts that yields a field.

    The strictest years and the highest pay bind (the first passage among equals); of level and hours the first.
    """
    p = F.col("p")
    rows = texts.select(key, F.posexplode(passages(F.col(text))).alias("pos", "p"))
    years = F.coalesce(_group(p, YEARS_RANGE, 1), _group(p, YEARS_LEAST, 1), _group(p, YEARS_LEAST, 2)).try_cast("int")
    hourly = F.array_max(F.transform(F.regexp_extract_all(p, F.lit(HOURLY), 1), lambda x: x.try_cast("double")))
    low, high = (F.transform(F.regexp_extract_all(p, F.lit(YEARLY), i), scaled) for i in (1, 2))
    spans = F.filter(F.arrays_zip(low.alias("low"), high.alias("high")), lambda s: (s["low"] >= 20000) & (s["high"] >= s["low"]))
    yearly = F.array_max(F.transform(spans, lambda s: s["high"]))
    said = F.lower(p)
    level = F.coalesce(_group(p, CEFR, 1), *(F.when(said.contains(w), F.lit(w)) for w in LEVELS))
    week = F.coalesce(F.when(p.rlike(HOURS_RANGE), F.concat_ws("-", _group(p, HOURS_RANGE, 1), _group(p, HOURS_RANGE, 2))), _group(p, HOURS_SINGLE, 1))
    found = rows.select(
        key, "pos", "p", F.when(years.between(1, 30), years).alias("min_years"), hourly.alias("pay_usd_hour_max"), yearly.alias("pay_usd_year_max"),
        F.when(said.contains("english"), level).alias("english_level"), week.alias("hours_per_week"),
    ).filter(" or ".join(f"{f} is not null" for f in FIELDS))
    best = []
    for f in FIELDS:
        have, at = F.col(f).isNotNull(), F.col("pos")
        if f in ("english_level", "hours_per_week"):
            pick = F.min(F.when(have, F.struct(at.alias("at"), F.col(f).alias("value"), p.alias("p"))))
        else:
            pick = F.max(F.when(have, F.struct(F.col(f).alias("value"), (-at).alias("at"), p.alias("p"))))
        best.append(pick.alias(f"_{f}"))
    grouped = found.groupBy(key).agg(*best)
    return grouped.select(key, *(F.col(f"_{f}.value").alias(f) for f in FIELDS), *(F.col(f"_{f}.p").alias(f"{f}_evidence") for f in FIELDS))


def supported(source: Column, evidence: Column) -> Column:
    """The evidence, clean and case folded, is 3 characters or more of the source."""
    said = clean_folded(evidence)
    return (F.length(said) >= 3) & F.contains(clean_folded(source), said)


def readable(value: Column, evidence: Column, number: bool) -> Column:
    """The value can be read in the evidence: as one of its numbers (to six digits), or as a part of its text."""
    if not number:
        return F.contains(clean_folded(evidence), clean_folded(value))
    six = lambda c: F.format_string("%.5e", c)
    told = F.transform(F.regexp_extract_all(evidence, F.lit(r"(\d[\d,]*(?:\.\d+)?)"), 1), lambda n: F.replace(n, F.lit(","), F.lit("")).try_cast("double"))
    return F.exists(told, lambda n: six(n) == six(value.cast("double")))


def enriched(postings: DataFrame, text: str, order: str) -> DataFrame:
    """postings with description_sha1 and the fields of rules(), which run once for each distinct description.

    The description travels once for each digest, not once for each posting.
    """
    marked = postings.withColumn("description_sha1", F.sha1(F.col(text)))
    distinct = marked.groupBy("description_sha1").agg(F.min_by(text, order).alias("_text"))
    return marked.drop(text).join(rules(distinct, "description_sha1", "_text"), "description_sha1", "left")


def rule_hits(found: DataFrame) -> DataFrame:
    """field, n: for how many distinct descriptions (description_sha1) of found a field was read."""
    by_text = found.groupBy("description_sha1").agg(*(F.max(F.col(f).isNotNull()).alias(f) for f in FIELDS))
    counts = by_text.agg(*(F.count_if(f).alias(f) for f in FIELDS))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("n")) for f in FIELDS))).alias("x")).select("x.*")


def open_fields(enriched_rows: DataFrame, texts: DataFrame, priority: Column, order: str) -> DataFrame:
    """description_sha1, rank, first_at, fields, text: what the rules left empty although the text (of texts) hints at it."""
    ranked = enriched_rows.groupBy("description_sha1").agg(F.min(priority).alias("rank"), F.min(order).alias("first_at"), *(F.max(F.col(f).isNull()).alias(f"no_{f}") for f in FIELDS))
    ranked = ranked.join(texts, "description_sha1")
    open_ = F.array(*(F.when(F.col(f"no_{f}") & F.col("text").rlike(HINTS[f]), F.lit(f)) for f in FIELDS))
    ranked = ranked.withColumn("fields", F.filter(open_, lambda x: x.isNotNull())).filter(F.size("fields") > 0)
    return ranked.select("description_sha1", "rank", "first_at", "fields", "text")


def wanted(enriched_rows: DataFrame, texts: DataFrame, priority: Column, order: str, calls: int) -> DataFrame:
    """Digests worth an external call, by priority, then first seen, up to the budget. The budget is the feature here."""
    return open_fields(enriched_rows, texts, priority, order).orderBy("rank", "first_at").limit(calls).select("description_sha1", "rank", "fields", "text")


OVER_BUDGET = "no calls left"


def unasked(open_: DataFrame, asked_: DataFrame) -> DataFrame:
    """description_sha1, field, reason: fields that the budget left open (open_ as open_fields() gives them)."""
    rest = open_.join(asked_.select("description_sha1"), "description_sha1", "left_anti")
    return rest.select("description_sha1", F.explode("fields").alias("field"), F.lit(OVER_BUDGET).alias("reason"))


def answer_schema(fields: tuple[str, ...] = FIELDS) -> dict:
    """The JSON schema that an extractor's answer has to meet: of each field a value and its evidence, both text or null."""
    told = {"type": ["string", "null"]}
    own = {"type": "object", "properties": {"value": told, "evidence": told}, "required": ["value", "evidence"], "additionalProperties": False}
    return {"type": "object", "properties": dict.fromkeys(fields, own), "required": list(fields), "additionalProperties": False}


def from_environment() -> tuple[Callable[[str, list[str]], dict[str, tuple[str, str]]], int] | None:
    """The extractor that TIDEMILL_EXTRACTOR names (module:function) and its budget (TIDEMILL_CALLS, 40 without one); None if none is named."""
    import importlib
    import os

    named = os.environ.get("TIDEMILL_EXTRACTOR")
    if not named:
        return None
    module, _, function = named.partition(":")
    return getattr(importlib.import_module(module), function), int(os.environ.get("TIDEMILL_CALLS", "40"))


def extracted(requests: DataFrame, extractor: Callable[[str, list[str]], dict[str, tuple[str, str]]], prompt: int = 12_000) -> DataFrame:
    """description_sha1, field, value, evidence, accepted, reason: answers of an extractor, accepted only with evidence that bears them.

    extractor: (text, fields) to field: (value, evidence); a client of some service, or a table in tests. The prompt's
    length is the service's limit. reason says why an answer is rejected.
    """
    import pandas as pd

    def ask(batches):
        for b in batches:
            out = []
            for digest, text, fields in zip(b["description_sha1"], b["text"], b["fields"]):
                for f, (value, evidence) in extractor(text[:prompt], list(fields)).items():
                    if f in fields and value not in (None, ""):
                        out.append((digest, f, str(value), evidence, text))
            yield pd.DataFrame(out, columns=["description_sha1", "field", "value", "evidence", "text"])

    told = requests.select("description_sha1", "text", "fields").mapInPandas(ask, "description_sha1 string, field string, value string, evidence string, text string")
    number = F.col("field").isin("min_years", "pay_usd_hour_max", "pay_usd_year_max")
    amount = F.col("value").try_cast("double")
    borne = F.when(number, readable(amount, F.col("evidence"), True)).otherwise(readable(F.col("value"), F.col("evidence"), False))
    reason = (
        F.when(number & amount.isNull(), "the value is no number")
        .when(~F.coalesce(supported(F.col("text"), F.col("evidence")), F.lit(False)), "the text has no such passage")
        .when(~F.coalesce(borne, F.lit(False)), "the passage does not say so")
    )
    return told.withColumn("reason", reason).withColumn("accepted", F.col("reason").isNull()).drop("text")


@dataclass
class Answers:
    """What an extractor said: accepted values, and what became of the other fields (description_sha1, field, reason)."""

    accepted: DataFrame
    rejected: DataFrame
    calls: int


def asked(rows: DataFrame, text: str, priority: Column, order: str, extractor: Callable[[str, list[str]], dict[str, tuple[str, str]]], calls: int) -> Answers:
    """What the extractor says of rows (with description_sha1, fields and text) and its evidence bears.

    Each description is asked about once: the answers, bounded by the budget, are fetched here and now.
    """
    texts = rows.groupBy("description_sha1").agg(F.min(text).alias("text"))
    open_ = open_fields(rows, texts, priority, order)
    chosen = kept(open_.orderBy("rank", "first_at").limit(calls))
    told = kept(extracted(chosen, extractor))
    rejected = told.filter("not accepted").select("description_sha1", "field", "reason").unionByName(unasked(open_, chosen))
    return Answers(told.filter("accepted").select("description_sha1", "field", "value", "evidence"), rejected, chosen.count())


def merged(rows: DataFrame, answers: DataFrame | None, by: str = "llm") -> DataFrame:
    """rows (description_sha1, fields, evidence) with answers in the fields that the rules left empty, and who read each field (_by).

    An answer that isn't of its field's type counts for nothing.
    """
    if answers is None:
        return rows.withColumns({f"{f}_by": F.when(F.col(f).isNotNull(), F.lit("rules")) for f in FIELDS})
    picks = [F.max(F.when(F.col("field") == f, F.struct("value", "evidence"))).alias(f"_{f}") for f in FIELDS]
    both = rows.join(answers.groupBy("description_sha1").agg(*picks), "description_sha1", "left")
    new = {}
    for f in FIELDS:
        said, kind = F.col(f"_{f}.value"), rows.schema[f].dataType
        if f == "min_years":
            number = said.try_cast("double")
            said = F.when(number == F.floor(number), number).try_cast("int")
        else:
            said = said.try_cast(kind)
        use = F.col(f).isNull() & said.isNotNull()
        new[f] = F.coalesce(F.col(f), said)
        new[f"{f}_evidence"] = F.when(use, clean(F.col(f"_{f}.evidence"))).otherwise(F.col(f"{f}_evidence"))
        new[f"{f}_by"] = F.when(use, F.lit(by)).when(F.col(f).isNotNull(), F.lit("rules"))
    return both.withColumns(new).drop(*(f"_{f}" for f in FIELDS))
