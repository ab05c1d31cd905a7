r"""Secret scans with multipart credential linking.

Base spans are matches of three patterns that stand on their own (assign, access, hex). Weak candidates say nothing alone:
a run of 40 base64 characters, a login name, an endpoint. They are reported only if complementary parts of a credential
lie in their scope, the text up to SCOPE code points before and after them:

    key        40 of A-Za-z0-9+/, with small and large letters and digits: an access or login part
    login      user, username, login, account, client_id with a value: a secret part (assign, hex, key) and an endpoint
    endpoint   an address with a scheme: an access or login part, and a secret part

A part of the same text as the candidate is no complement, and a candidate that overlaps a base span is reported as that
alone. Parts meet through an interval join: scopes and parts are put in bins of SCOPE code points of their text, and only
those of one bin are compared. Parts of one kind don't overlap, so that a scope meets a bounded number of them, whatever
the document holds.

Everything here is DataFrame functions. A text is scanned whole, by Java's regular expressions; places are code points, end
exclusive. Defined results: a null text is empty and has no spans; rows are results of their own, whatever their doc_id
(null, repeated); an empty table gives an empty one; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import stored

# The kinds in the order in which spans of one place are listed, and what matches them.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
KEY = r"[A-Za-z0-9+/]{40,}"
LOGIN = r"""(?i)(user|username|login|account|client_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)"""
ENDPOINT = r"(https?|ftp|ssh|amqps?|mysql|postgres|postgresql|mongodb|redis|s3)://[A-Za-z0-9.:@_%-]+"
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "key": KEY, "login": LOGIN, "endpoint": ENDPOINT}
#: What a text must hold, one of them, for a pattern to match: a text without is not read by that pattern.
NEEDS = {"assign": (":", "="), "access": ("AKIA",), "login": (":", "="), "endpoint": ("://",)}
BASE = ("assign", "access", "hex")
KINDS = tuple(PATTERNS)
#: Code points before and after a candidate that its complements may lie in.
SCOPE = 200
#: Matches whose places are summed up at a time.
CHUNK = 512

SPAN = "struct<start:long,kind:int,end:long>"


def _kept(kind: str, match: Column) -> Column:
    """Whether a match is long enough, or looks as it must."""
    if kind == "assign":
        return F.length(F.regexp_extract(match, ASSIGN, 2)) >= 8
    if kind == "access":
        return F.length(match) >= 16
    if kind == "key":
        return (F.length(match) == 40) & match.rlike("[a-z]") & match.rlike("[A-Z]") & match.rlike("[0-9]")
    return F.length(F.regexp_extract(match, LOGIN, 2)) >= 3 if kind == "login" else F.lit(True)


def _summed(text: Column, found: Column, kind: str) -> Column:
    """The matches in chunks: each with its spans, counted from its beginning, and what gaps and matches come to.

    Places are what the gaps and matches before come to; only a chunk's are summed here, and the chunks' in _placed, so
    that a text with very many matches costs little more than its matches.
    """
    pattern = PATTERNS[kind]
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    long = lambda x: x.cast("long")
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(long(g).alias("gap"), long(F.length(m)).alias("size"), _kept(kind, m).alias("kept")))

    def more(s, x):
        start = s["at"] + x["gap"]
        span = F.array(F.struct(start.alias("start"), (start + x["size"]).alias("end")))
        return F.struct((start + x["size"]).alias("at"), F.when(x["kept"], F.concat(s["out"], span)).otherwise(s["out"]).alias("out"))

    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("out"))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / CHUNK).cast("int")), lambda i: F.aggregate(F.slice(steps, i * CHUNK + 1, F.lit(CHUNK)), nothing, more))
    return F.when(F.size(found) > 0, chunks).otherwise(F.array()).cast("array<struct<at:long,out:array<struct<start:long,end:long>>>>")


def _placed(chunks: Column, kind: str) -> Column:
    """SPANs of chunks, each counted from the beginning of the text."""
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("out"))
    starts = F.aggregate(chunks, nothing, lambda s, c: F.struct((s["at"] + c["at"]).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")))["out"]
    number = F.lit(KINDS.index(kind))
    moved = lambda c, at: F.transform(c["out"], lambda x: F.struct((x["start"] + at).alias("start"), number.alias("kind"), (x["end"] + at).alias("end")))
    return F.flatten(F.zip_with(chunks, starts, moved)).cast(f"array<{SPAN}>")


def _matches(kind: str) -> Column:
    every = F.regexp_extract_all("_text", F.lit(PATTERNS[kind]), F.lit(0))
    if kind not in NEEDS:
        return every
    some = [F.contains(F.col("_text"), F.lit(x)) for x in NEEDS[kind]]
    return F.when(some[0] if len(some) == 1 else some[0] | some[1], every).otherwise(F.array().cast("array<string>"))


def found(documents: DataFrame) -> DataFrame:
    """doc_id, base, weak (arrays of SPAN) of each row; one narrow pass over the texts."""
    texts = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    matched = texts.select("doc_id", "_text", *(_matches(k).alias(k) for k in KINDS))
    summed = matched.select("doc_id", *(_summed(F.col("_text"), F.col(k), k).alias(k) for k in KINDS))
    all_of = lambda kinds: F.array_sort(F.concat(*(_placed(F.col(k), k) for k in kinds)))
    return summed.select("doc_id", all_of(BASE).alias("base"), all_of(KINDS[len(BASE) :]).alias("weak"))


def linked(rows: DataFrame) -> DataFrame:
    """row, links (array of SPAN): the weak candidates of rows (row, base, weak) whose complements lie in their scope."""
    some = rows.filter(F.size("weak") > 0)
    bins = lambda start, end: F.explode(F.sequence(F.floor(start / SCOPE), F.floor(end / SCOPE))).alias("bin")
    weak = some.select("row", F.explode("weak").alias("w")).select("row", "w", bins(F.col("w.start") - SCOPE, F.col("w.end") + SCOPE))
    parts = some.select("row", F.explode(F.concat("base", "weak")).alias("p")).select("row", "p", bins(F.col("p.start"), F.col("p.end") - 1))
    w, p = (lambda c: F.col(f"w.{c}")), (lambda c: F.col(f"p.{c}"))
    both = weak.join(parts, ["row", "bin"]).filter((p("start") < w("end") + SCOPE) & (p("end") > w("start") - SCOPE))
    apart = (p("end") <= w("start")) | (p("start") >= w("end"))
    has = lambda *kinds: F.bool_or(apart & p("kind").isin(*map(KINDS.index, kinds)))
    told = both.groupBy("row", "w").agg(
        F.bool_or(~apart & (p("kind") < len(BASE))).alias("clash"), has("access", "login").alias("who"), has("assign", "hex", "key").alias("what"), has("endpoint").alias("where")
    )
    kind = lambda name: w("kind") == KINDS.index(name)
    whole = (kind("key") & F.col("who")) | (kind("login") & F.col("what") & F.col("where")) | (kind("endpoint") & F.col("who") & F.col("what"))
    return told.filter(~F.col("clash") & whole).groupBy("row").agg(F.collect_list("w").alias("links"))


def told(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, base, spans (arrays of SPAN by start, then kind): what stands alone, and with it what linking adds."""
    # the row numbers hold because the rows are written with them
    rows = stored(found(documents).withColumn("row", F.monotonically_increasing_id()), "secret-spans")
    links = linked(rows)
    return rows.join(links, "row", "left").select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("links", F.array().cast(f"array<{SPAN}>")))).alias("spans"))
