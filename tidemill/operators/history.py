"""Snapshots kept over time: diffs without a shuffle, families kept up from diffs alone, distinct counts that merge.

A kept snapshot is a table bucketed by its key, so that two of them are joined bucket by bucket where they lie. From the
rows that differ, a ledger takes back what closed postings gave to their families and adds what new ones give; only
families that it touches are rolled up again. Beside each snapshot lie sketches of its distinct values, which merge,
intersect and subtract without reading the snapshots again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.sources.files import delete, scratch

#: Rows that a bucket is made for.
BUCKET_ROWS = 1 << 20


@dataclass(frozen=True)
class Kept:
    """A snapshot as a bucketed table at a path."""

    name: str
    path: str
    rows: DataFrame

    def drop(self) -> None:
        self.rows.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete(self.rows.sparkSession, self.path)


def buckets_for(rows: int, cores: int) -> int:
    """A power of two, so that snapshots of different sizes still meet bucket by bucket."""
    least = max(cores, -(-rows // BUCKET_ROWS))
    return 1 << (least - 1).bit_length()


def keep(df: DataFrame, key: list[str], buckets: int, path: str | None = None) -> Kept:
    """df as a table in so many buckets of its key, one file each. Writing it is the only shuffle that its diffs need."""
    spark, name = df.sparkSession, f"kept_{uuid.uuid4().hex}"
    path = path or scratch(spark, "snapshot")
    df.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key).option("path", path).saveAsTable(name)
    return Kept(name, path, spark.table(name))


def signed(previous: DataFrame, current: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """columns and _n: rows of previous that are closed or changed (-1), rows of current that are new or changed (1).

    Of kept snapshots nothing is shuffled; keys are unique in each.
    """
    a = previous.select(*key, F.struct(*columns).alias("_was"))
    b = current.select(*key, F.struct(*columns).alias("_is"))
    both = a.join(b, key, "full_outer").filter(~F.col("_was").eqNullSafe(F.col("_is")))
    sides = F.array(F.struct(F.lit(-1).alias("n"), F.col("_was").alias("r")), F.struct(F.lit(1).alias("n"), F.col("_is").alias("r")))
    return both.select(F.explode(F.filter(sides, lambda x: x["r"].isNotNull())).alias("x")).select("x.r.*", F.col("x.n").alias("_n"))


# Families

#: What families() reads of a posting, beside its order.
FAMILY_COLUMNS = ["family_id", "company", "title", "countries", "open_to_colombia", "min_years", "english_level", "pay_usd_hour_max", "pay_usd_year_max", "published", "url"]
_ENTRY = ["family_id", "field", "num", "day", "at", "told"]


def ledger(postings: DataFrame, order: str, n: Column | None = None) -> DataFrame:
    """family_id, field, num, day, at, told, n: how often each value that a family is rolled up from occurs in it.

    n: what a row counts for (1, or -1 for one that goes). order is a posting's own, unique and the same in all snapshots.
    """
    c = F.col
    kind = postings.schema[order].dataType.simpleString()

    def entry(field: str, num=None, day=None, at=None, told=None) -> Column:
        return F.struct(
            F.lit(field).alias("field"), F.lit(num).cast("double").alias("num"), F.lit(day).cast("date").alias("day"), F.lit(at).cast(kind).alias("at"), F.lit(told).cast("array<string>").alias("told")
        )

    some = lambda test, x: F.when(test, x)
    eligible = c("open_to_colombia") == F.lit(True)
    fields = [
        entry("posting"),
        entry("head", at=c(order), told=F.array("company", "title")),
        entry("open", num=F.when(c("open_to_colombia"), 2).when(c("open_to_colombia").isNull(), 1).otherwise(0)),
        entry("url", at=c(order), told=F.array("url")),
        some(eligible, entry("open url", at=c(order), told=F.array("url"))),
        some(c("english_level").isNotNull() & (c("english_level") != ""), entry("english", at=c(order), told=F.array("english_level"))),
        *(some(c(f).isNotNull(), entry(f, num=c(f))) for f in ("min_years", "pay_usd_hour_max", "pay_usd_year_max")),
        some(c("published").isNotNull(), entry("published", day=c("published"))),
    ]
    places = F.transform(F.array_distinct(F.coalesce("countries", F.array().cast("array<string>"))), lambda x: entry("country", told=F.array(x)))
    every = F.filter(F.concat(F.array(*fields), places), lambda x: x.isNotNull())
    rows = postings.select("family_id", (F.lit(1) if n is None else n).cast("long").alias("n"), F.inline(every))
    return settled(rows)


def settled(entries: DataFrame) -> DataFrame:
    return entries.groupBy(*_ENTRY).agg(F.sum("n").alias("n")).filter("n <> 0")


def families_of(entries: DataFrame) -> DataFrame:
    """What snapshots.families() gives for the postings that a ledger counts."""
    field = lambda name: F.col("field") == name
    first = lambda name, i=0: F.min_by(F.get("told", F.lit(i)), F.when(field(name), F.col("at")))
    top = F.max(F.when(field("open"), F.col("num")))
    most = lambda name: F.max(F.when(field(name), F.col("num")))
    day = F.when(field("published"), F.col("day"))
    return entries.groupBy("family_id").agg(
        first("head").alias("company"),
        first("head", 1).alias("title"),
        F.sum(F.when(field("posting"), F.col("n"))).alias("postings"),
        F.array_sort(F.collect_set(F.when(field("country"), F.get("told", F.lit(0))))).alias("countries"),
        F.when(top == 2, True).when(top == 0, False).alias("open_to_colombia"),
        most("min_years").cast("int").alias("min_years"),
        first("english").alias("english_level"),
        most("pay_usd_hour_max").alias("pay_usd_hour_max"),
        most("pay_usd_year_max").alias("pay_usd_year_max"),
        F.min(day).alias("first_published"),
        F.max(day).alias("last_published"),
        F.coalesce(first("open url"), first("url")).alias("url"),
    )


def kept_up(entries: DataFrame, families: DataFrame, changes: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """The ledger and the families after changes (what signed() gives): families without a change are carried as they are."""
    delta = ledger(changes, order, F.col("_n"))
    touched = changes.select("family_id").distinct()
    again = settled(entries.join(touched, "family_id", "left_semi").unionByName(delta))
    still = entries.join(touched, "family_id", "left_anti").unionByName(again)
    return still, families.join(touched, "family_id", "left_anti").unionByName(families_of(again))


# Distinct counts

#: Sketches keep 2^LOG_K hashes: a relative error of about 1 / sqrt(2^LOG_K), 1.6 % here, with 68 % confidence.
LOG_K = 12


def sketched(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row: a sketch of the distinct values of each column (null is none), and their exact number beside it (column_n)."""
    return rows.agg(*(F.theta_sketch_agg(c, LOG_K).alias(c) for c in columns), *(F.count_distinct(c).alias(f"{c}_n") for c in columns))


def over_all(sketches: DataFrame, columns: list[str]) -> DataFrame:
    """column_about: how many distinct values any of the snapshots had, from their sketches alone (one row for each snapshot)."""
    return sketches.agg(*(F.theta_sketch_estimate(F.theta_union_agg(c, LOG_K)).alias(f"{c}_about") for c in columns))


def compared(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """both, gone, come: how many distinct values two snapshots share, and only the former or the latter has (estimates)."""
    a, b = before.select(F.col(column).alias("a")), after.select(F.col(column).alias("b"))
    one = a.join(b, F.lit(True))  # one row on either side
    told = lambda x: F.theta_sketch_estimate(x)
    return one.select(told(F.theta_intersection("a", "b")).alias("both"), told(F.theta_difference("a", "b")).alias("gone"), told(F.theta_difference("b", "a")).alias("come"))
