"""Snapshots over time: diff, carry-over, silent groups, families, changelog."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def three_valued_or(flag: Column) -> Column:
    """True if any is true, else null if any is null, else false (an aggregate)."""
    top = F.max(F.when(flag, 2).when(flag.isNull(), 1).otherwise(0))
    return F.when(top == 2, True).when(top == 0, False)


def histogram(rows: DataFrame, flag: Column, name: str = "flag") -> DataFrame:
    """How many rows have each value of a flag, null (not stated) included."""
    return rows.groupBy(flag.alias(name)).agg(F.count("*").alias("n"))


def union_of(rows: DataFrame, group: list[str], value: str, name: str) -> DataFrame:
    """The sorted distinct values of each group."""
    return rows.groupBy(*group).agg(F.array_sort(F.collect_set(value)).alias(name))


def diff(previous: DataFrame, current: DataFrame, key: list[str], signature: list[str]) -> DataFrame:
    """key and change (new, closed or changed) of all keys that differ; in_order() sorts them for a report."""
    sign = F.struct(*signature)
    a = previous.select(*key, sign.alias("_was"), F.lit(True).alias("_a"))
    b = current.select(*key, sign.alias("_is"), F.lit(True).alias("_b"))
    both = a.join(b, key, "full_outer")
    change = F.when(F.col("_a").isNull(), "new").when(F.col("_b").isNull(), "closed").when(~F.col("_was").eqNullSafe(F.col("_is")), "changed")
    return both.withColumn("change", change).filter("change is not null").select(*key, "change")


def in_order(changes: DataFrame, key: list[str]) -> DataFrame:
    """Changes as a report lists them: new, closed, changed, each by key."""
    return changes.orderBy(F.array_position(F.array(F.lit("new"), F.lit("closed"), F.lit("changed")), F.col("change")), *key)


def carried(previous: DataFrame, current: DataFrame, failed: DataFrame, group: str) -> DataFrame:
    """current, and previous rows of groups that failed this time (failed: group)."""
    return current.unionByName(previous.join(failed.select(group).distinct(), group, "left_semi").select(*current.columns))


def silent(previous: DataFrame, current: DataFrame, failed: DataFrame, configured: DataFrame, group: str, least: int = 5) -> DataFrame:
    """Configured groups that had `least` rows or more, did not fail, and have none now."""
    before = previous.groupBy(group).agg(F.count("*").alias("before")).filter(F.col("before") >= least)
    before = before.join(configured.select(group).distinct(), group, "left_semi")
    return before.join(failed.select(group).distinct(), group, "left_anti").join(current.select(group).distinct(), group, "left_anti")


def retired(previous: DataFrame, configured: DataFrame, group: str) -> DataFrame:
    """Groups of the previous snapshot that are configured no more."""
    return previous.groupBy(group).agg(F.count("*").alias("before")).join(configured.select(group).distinct(), group, "left_anti")


def first_of(value: str, order: str, when: Column | None = None) -> Column:
    """The value of the first row by order (of those that meet `when`)."""
    at = F.col(order) if when is None else F.when(when, F.col(order))
    return F.min_by(value, at)


def families(postings: DataFrame, order: str) -> DataFrame:
    """One row for each family_id of postings; `order` gives which row is first."""
    eligible = F.col("open_to_colombia") == F.lit(True)
    told = F.col("english_level").isNotNull() & (F.col("english_level") != "")
    return postings.groupBy("family_id").agg(
        first_of("company", order).alias("company"),
        first_of("title", order).alias("title"),
        F.count("*").alias("postings"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("countries")))).alias("countries"),
        three_valued_or(F.col("open_to_colombia")).alias("open_to_colombia"),
        F.max("min_years").alias("min_years"),
        first_of("english_level", order, told).alias("english_level"),
        F.max("pay_usd_hour_max").alias("pay_usd_hour_max"),
        F.max("pay_usd_year_max").alias("pay_usd_year_max"),
        F.min("published").alias("first_published"),
        F.max("published").alias("last_published"),
        F.coalesce(first_of("url", order, eligible), first_of("url", order)).alias("url"),
    )


def top_groups(rows: DataFrame, group: list[str], order: str, countries: str | None = None, limit: int = 15, shown: int = 8) -> DataFrame:
    """The largest groups, ties by first appearance; with the first few of their countries if asked for."""
    more = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(countries)))).alias("countries")] if countries else []
    found = rows.groupBy(*group).agg(F.count("*").alias("n"), F.min(order).alias("first_at"), *more)
    found = found.orderBy(F.desc("n"), "first_at").limit(limit)
    return found.withColumn("shown", F.slice("countries", 1, shown)) if countries else found


def changelog_entry(day: dt.date, current: DataFrame, changes: dict[str, DataFrame], order: str, first_run: bool, limit: int = 15) -> str:
    """The text of one run's entry. changes: new, closed and changed postings (company, title, countries)."""
    total = current.agg(F.count("*").alias("n"), F.countDistinct("family_id").alias("f")).first()
    if first_run:
        return f"## {day} · first snapshot: {total['n']} postings in {total['f']} families\n"
    n = {k: df.count() for k, df in changes.items()}
    lines = [f"## {day} · {total['n']} postings · +{n['new']} new · -{n['closed']} closed · ~{n['changed']} changed", ""]
    for kind, df in changes.items():
        if not n[kind]:
            continue
        lines += [f"**{kind.capitalize()}**", ""]
        for r in top_groups(df, ["company", "title"], order, "countries", limit).orderBy(F.desc("n"), "first_at").collect():
            where = ", ".join(r["shown"]) + (", ..." if len(r["countries"]) > len(r["shown"]) else "")
            lines.append(f"- {r['company']} · {r['title']} · {r['n']}" + (f" ({where})" if where else ""))
        more = df.select("company", "title").distinct().count() - limit
        lines += [f"- ... and {more} more families"] * (more > 0) + [""]
    return "\n".join(lines).rstrip() + "\n"


def forward_filled(rows: DataFrame, value: Column, group: list[str], order: str, name: str) -> DataFrame:
    """rows with the last value that was not null up to each row."""
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(Window.partitionBy(*group).orderBy(order)))
