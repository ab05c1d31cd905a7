"""What is left to do beside a very large done set: a partitioned Bloom filter before the anti join, which stays exact after it.

An anti join shuffles all of todo, payloads included. Here a filter of the done keys, broadcast in parts, first tells which rows
of todo are surely not done: they go on where they are. Only rows that may be done (all that are, and a few per cent of
the others) are shuffled to the exact anti join. The filter is a table (a part's words in each row) that a resume keeps
beside its done set and grows by new keys alone; it is worth most there, since building it anew reads the whole done set.

Each key sets BITS bits of one 64-bit word, so a key is one row of the aggregate that builds the filter and one word of a
look-up. A filter takes MOST_BYTES at most: up to KEYS keys a word it lets few through, up to DENSEST more; a done set
beyond that gets no filter, and its anti join is the plain one. The rows are the same in all cases.

Keys are integers, strings or dates (whose text is equal where they are). A null key is never done. Rows repeat as in todo.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.sources import ingest
from tidemill.sources.files import kept

BITS = 4
#: Keys of a word: as many as a new filter is made for, and the most that one may come to hold.
KEYS, DENSEST = 4, 12
#: Words of a part, and bytes of a whole filter, which is broadcast.
WORDS, MOST_BYTES = 1 << 18, 32 << 20


@dataclass(frozen=True)
class Done:
    """A filter of done keys: its table (part, words), how many parts, and how many words in each."""

    table: DataFrame
    parts: int
    words: int


def sized(keys: int, most_bytes: int = MOST_BYTES) -> tuple[int, int] | None:
    """Parts and words of a filter for so many keys; None if no filter of that size would be of use."""
    most = most_bytes // 8
    if keys > DENSEST * most:
        return None
    total = max(1, min(-(-keys // KEYS), most))
    parts = -(-total // WORDS)
    return parts, total // parts


def _text(rows: DataFrame, key: str) -> Column:
    kind = rows.schema[key].dataType
    if not isinstance(kind, (T.IntegralType, T.DateType)) and kind != T.StringType():
        raise ValueError(f"{key} is {kind.simpleString()}; a filter takes integers, strings and dates")
    return rows[key].cast("string")


def _place(text: Column, parts: int, words: int) -> tuple[Column, Column]:
    """The word of the whole filter that a key belongs to, and its bits there."""
    h = F.xxhash64(text, F.lit(1))
    one = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * i).bitwiseAND(63).cast("int"))
    bits = one(0)
    for i in range(1, BITS):
        bits = bits.bitwiseOR(one(i))
    return F.pmod(F.xxhash64(text), F.lit(parts * words)), bits


def built(done: DataFrame, key: str, parts: int, words: int) -> DataFrame:
    """part, words of the done keys: each task first combines its own keys by word; a part is gathered by one task."""
    at, bits = _place(_text(done, key), parts, words)
    rows = done.filter(done[key].isNotNull()).select(at.alias("at"), bits.alias("bits"))
    blank = done.sparkSession.range(parts * words).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("bits"))
    rows = rows.union(blank).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    part = F.floor(F.col("at") / words).cast("int")
    told = rows.groupBy(part.alias("part")).agg(F.array_sort(F.collect_list(F.struct("at", "bits"))).alias("w"))
    return told.select("part", F.transform("w", lambda w: w["bits"]).alias("words"))


def filter_of(done: DataFrame, key: str, most_bytes: int = MOST_BYTES, expected: int = 0) -> Done | None:
    """A filter of the done keys, with room for as many as are expected; None if they are too many for one."""
    size = sized(max(done.count(), expected), most_bytes)
    return size and Done(kept(built(done, key, *size), "done"), *size)


def grown(old: Done, new: DataFrame, key: str) -> Done:
    """The filter with new done keys besides: reads these keys and the filter, not the done set."""
    more = built(new, key, old.parts, old.words).withColumnRenamed("words", "more")
    both = old.table.join(more, "part").select("part", F.zip_with("words", "more", lambda a, b: a.bitwiseOR(b)).alias("words"))
    return Done(kept(both, "done"), old.parts, old.words)


def save(done: Done, path: str) -> None:
    done.table.write.parquet(path)


def load(spark: SparkSession, path: str) -> Done:
    table = spark.read.schema("part int, words array<bigint>").parquet(path)
    size = table.agg(F.count("*").alias("parts"), F.max(F.size("words")).alias("words")).first()
    return Done(table, size["parts"], size["words"])


def passes(done: Done) -> float:
    """The share of keys that are not done and yet get through. Near 1, make a larger filter."""
    full = F.aggregate("words", F.lit(0.0), lambda s, w: s + F.pow(F.bit_count(w) / 64, BITS))
    return done.table.agg(F.sum(full)).first()[0] / (done.parts * done.words)


def split(todo: DataFrame, done: Done, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of todo that are surely not done, and those that may be. Neither shuffles."""
    at, bits = _place(_text(todo, key), done.parts, done.words)
    table = F.broadcast(done.table)
    word = F.element_at(table["words"], (F.pmod(at, F.lit(done.words)) + 1).cast("int"))
    hit = (F.floor(at / done.words).cast("int") == table["part"]) & (word.bitwiseAND(bits) == bits)
    return todo.join(table, hit, "left_anti"), todo.join(table, hit, "left_semi")


def remaining(todo: DataFrame, done: DataFrame, key: str, known: Done | None = None, most_bytes: int = MOST_BYTES) -> DataFrame:
    """ingest.remaining(todo, done, key), row for row; known: a kept filter that holds all done keys at least."""
    one, two = todo.schema[key].dataType, done.schema[key].dataType
    if one != two and not (isinstance(one, T.IntegralType) and isinstance(two, T.IntegralType)):
        raise ValueError(f"{key} is {one.simpleString()} in one table and {two.simpleString()} in the other")
    known = known or filter_of(done, key, most_bytes)
    if known is None:
        return ingest.remaining(todo, done, key).select(todo.columns)
    surely, maybe = split(todo, known, key)
    return surely.union(ingest.remaining(maybe, done, key).select(todo.columns))
