"""Readers of saved payloads: boards, snapshots, checkpoints, pages that link to each other.

Payloads are fetched elsewhere and replayed from files or tables; nothing here opens a connection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.files import forget, kept
from tidemill.sources.parsers import ENDPOINTS

BOARDS = "company string, source string, board string"


def boards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BOARDS).json(path, multiLine=True)


def endpoint(source: Column, board: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ENDPOINTS.items() for x in pair])
    return F.replace(F.try_element_at(known, source), F.lit("{board}"), board)


def answered(boards_: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Boards with their body, and boards that failed (no answer, an error status, or a body that isn't JSON), each with a reason."""
    both = boards_.join(responses.select("source", "board", "status", "body"), ["source", "board"], "left")
    reason = F.when(F.col("status").isNull(), "no answer").when(F.col("status") >= 400, F.concat(F.lit("status "), F.col("status").cast("string"))).when(F.try_parse_json("body").isNull(), "body is not JSON")
    both = both.withColumn("reason", reason)
    return both.filter("reason is null").select("source", "board", "company", "body"), both.filter("reason is not null").select("source", "board", "company", "reason")


def snapshot(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows at path, or none if there is no snapshot yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def checkpoint(lines: DataFrame, value: str, resume: bool = True) -> DataFrame:
    """key, value: lines (line_no, line) of a checkpoint file; a torn line is skipped, the last of a key counts."""
    kind = f"struct<key:string,value:{value}>"
    rows = lines.select("line_no", F.from_json("line", kind).alias("r")).filter("r.key is not null")
    done = rows.groupBy("r.key").agg(F.max_by("r.value", "line_no").alias("value"))
    return done if resume else done.limit(0)


def remaining(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return todo.join(done.select(key), key, "left_anti")


def finished(todo: DataFrame, done: DataFrame, key: str, order: str) -> DataFrame:
    return todo.join(done, key).orderBy(order)


def walk(pages: DataFrame, starts: DataFrame) -> DataFrame:
    """url, step: the pages that next links reach from each start (url), in order; a link back ends its walk.

    pages: url, next_url. All starts go on together, by jumps of twice the length each round, until no start reaches a new
    page: a walk of n pages takes about log2(n) rounds, and nothing is capped. A page that a start reaches again keeps its
    first step, which cuts every cycle where it closes. Repeated rows of pages repeat in the result; of several next links
    of one url, each is followed.
    """
    rows = pages.select("url", "next_url").filter("url is not null")
    urls = rows.select("url").distinct()
    jumps = rows.select(F.col("url").alias("at"), F.col("next_url").alias("to")).distinct().join(urls.withColumnRenamed("url", "to"), "to", "left_semi").select("at", "to")
    reached = urls.join(starts.select("url"), "url", "left_semi").select(F.col("url").alias("start"), "url", F.lit(0).cast("long").alias("step"))
    jumps, reached, length = kept(jumps), kept(reached), 1
    n = reached.count()
    while True:
        far = reached.join(jumps, F.col("url") == F.col("at")).select("start", F.col("to").alias("url"), (F.col("step") + F.lit(length).cast("long")).alias("step"))
        old, reached = reached, kept(reached.union(far).groupBy("start", "url").agg(F.min("step").alias("step")))
        forget(old)
        before, n = n, reached.count()
        if n == before:
            forget(jumps)
            return rows.select("url").join(reached.select("url", "step"), "url")
        old, jumps = jumps, kept(jumps.join(jumps.select(F.col("at").alias("to"), F.col("to").alias("end")), "to").select("at", F.col("end").alias("to")).distinct())
        forget(old)
        length *= 2


def page_gaps(pages: DataFrame) -> DataFrame:
    """listing, page: numbered pages (listing, page, has_next) that are missing: before the last, or after one that has a next."""
    ends = pages.groupBy("listing").agg(F.max("page").alias("last"), F.max_by("has_next", "page").alias("more"))
    want = ends.select("listing", F.explode(F.sequence(F.lit(1), F.col("last") + F.col("more").cast("int"))).alias("page"))
    return want.join(pages.select("listing", "page"), ["listing", "page"], "left_anti")


def first_categories(categories: DataFrame, most: int) -> DataFrame:
    """A partial run: the first categories by position (coverage is then not checked)."""
    return categories.orderBy("pos").limit(most)


def first_listing(listed: DataFrame) -> DataFrame:
    """url and the category of the first listing that has it."""
    return listed.groupBy("url").agg(F.min_by("category", F.struct("listing_no", "pos")).alias("category"), F.min(F.struct("listing_no", "pos")).alias("at"))
