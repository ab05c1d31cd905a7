"""Mixing sources to target weights by entropy balancing.

Among all non-negative document rates with the wanted number of words in each source, the closest to 1 in relative
entropy are exponentially tilted: rate = min(most, exp(lambda * size / scale)), with one lambda for each source. The
lambdas solve the convex dual: distributed Newton steps (one aggregation each over a histogram of sizes), kept inside a
bracket. Rates are then rounded to whole copies: a document gets floor(rate) copies and one more if a hash of it falls
below the rest of its rate plus a shift; the shift of each source is found by counting words below ever finer cuts, so
that the words taken meet the target within about the size of one document.

Sources go by code point, null last, and weigh 5, 2, 1, repeating. The total of the targets is the total of all sizes;
a target stops at `most` times its source's size and the excess goes to the others by weight.

Defined results: a null text has size 0; documents without words have rate 1 and take no words. Repeated rows (equal
doc_id, source and size) get equal copies. Reruns agree. The driver holds a few numbers for each source, never for a
document; up to BROADCAST sources that table is broadcast, beyond it the joins shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import local, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
BROADCAST = 20_000
STEPS, CUTS, LEVELS = 40, 64, 4


def size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict, weights: tuple = WEIGHTS, most: float = MOST) -> dict:
    """Words wanted of each source, from words that each has."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    wanted, open_, rest = {}, set(order), float(sum(sizes.values()))
    while open_:
        share = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * share > most * sizes[s]}
        if not full:
            return wanted | {s: weight[s] * share for s in open_}
        for s in full:
            wanted[s] = float(most * sizes[s])
            rest -= wanted[s]
        open_ -= full
    return wanted


@dataclass
class Source:
    """What the driver knows of one source while it solves."""

    words: int
    target: float
    scale: float
    tilt: float = 0.0
    low: float = -math.inf
    high: float = math.inf
    shift: float = 0.0

    @property
    def full(self) -> bool:
        return self.target >= MOST * self.words * (1 - 1e-12)

    def newton(self, got: float, slope: float) -> bool:
        """One step towards the target; whether it is there."""
        miss = got - self.target
        if abs(miss) <= 1e-7 * self.target:
            return True
        if miss > 0:
            self.high = self.tilt
        else:
            self.low = self.tilt
        after = self.tilt - miss / slope if slope > 0 else math.inf
        if not self.low < after < self.high:
            after = (self.low + self.high) / 2 if math.isfinite(self.low + self.high) else self.tilt + (2.0 if miss < 0 else -2.0) * (1 + abs(self.tilt))
        self.tilt = after
        return False


def _with(rows: DataFrame, sources: dict, values: dict) -> DataFrame:
    """rows with the columns of values (name: function of a Source) by their source, null included."""
    spark = rows.sparkSession
    table = local(spark, [(s, *(float(f(x)) for f in values.values())) for s, x in sources.items()], "_source string, " + ", ".join(f"{n} double" for n in values))
    if len(sources) <= BROADCAST:
        table = F.broadcast(table)
    return rows.join(table, rows["source"].eqNullSafe(table["_source"])).drop("_source")


def rate() -> Column:
    return F.least(F.lit(float(MOST)), F.exp(F.least(F.lit(60.0), F.col("tilt") * F.col("size") / F.col("scale"))))


def solve(histogram: DataFrame, sources: dict, steps: int = STEPS) -> None:
    """Sets each source's tilt by Newton steps on the dual."""
    open_ = {s: x for s, x in sources.items() if x.words and not x.full}
    for _ in range(steps):
        if not open_:
            return
        rows = _with(histogram, open_, {"tilt": lambda x: x.tilt, "scale": lambda x: x.scale}).withColumn("rate", rate())
        words = F.col("n") * F.col("size") * F.col("rate")
        got = rows.groupBy("source").agg(F.sum(words).alias("got"), F.sum(F.when(F.col("rate") < MOST, words * F.col("size") / F.col("scale")).otherwise(0.0)).alias("slope")).collect()
        open_ = {r["source"]: open_[r["source"]] for r in got if not open_[r["source"]].newton(r["got"], r["slope"])}


def copies_of(sizes: DataFrame, sources: dict) -> DataFrame:
    """sizes with rate, whole (its floor) and key: one copy more if key < the source's shift."""
    rows = _with(sizes, sources, {"tilt": lambda x: x.tilt, "scale": lambda x: x.scale, "flat": lambda x: MOST if x.full else 0, "shift": lambda x: x.shift})
    rows = rows.withColumn("rate", F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("flat") > 0, F.col("flat")).otherwise(rate()))
    rows = rows.withColumn("whole", F.floor("rate"))
    even = F.shiftrightunsigned(F.xxhash64("doc_id", "source", "size", F.lit(29)), 11) / F.lit(float(1 << 53))
    return rows.withColumn("key", F.when((F.col("rate") < MOST) & (F.col("size") > 0), even - (F.col("rate") - F.col("whole"))))


def balance(sizes: DataFrame, sources: dict) -> None:
    """Sets each source's shift so that whole copies meet its target."""
    base = {r["source"]: r["words"] for r in copies_of(sizes, sources).groupBy("source").agg(F.sum(F.col("whole") * F.col("size")).alias("words")).collect()}
    state = {s: [-1.0, 2.0, x.target - base.get(s, 0)] for s, x in sources.items() if x.words and not x.full}
    for _ in range(LEVELS):
        if not state:
            return
        rows = copies_of(sizes, {s: sources[s] for s in state})
        cuts = local(sizes.sparkSession, [(s, a, w) for s, (a, w, _) in state.items()], "_source string, low double, wide double")
        if len(state) <= BROADCAST:
            cuts = F.broadcast(cuts)
        rows = rows.join(cuts, rows["source"].eqNullSafe(cuts["_source"]))
        rows = rows.filter((F.col("key") >= F.col("low")) & (F.col("key") < F.col("low") + F.col("wide")))
        bins = rows.groupBy("source", F.least(F.floor((F.col("key") - F.col("low")) / F.col("wide") * CUTS), F.lit(CUTS - 1)).alias("bin")).agg(F.sum("size").alias("words")).collect()
        found: dict = {}
        for r in bins:
            found.setdefault(r["source"], {})[int(r["bin"])] = r["words"]
        for s, (a, w, lack) in list(state.items()):
            step = w / CUTS
            for k in range(CUTS):
                words = found.get(s, {}).get(k, 0)
                if words > lack or k == CUTS - 1:
                    break
                lack -= words
            state[s] = [a + k * step, step, lack]
            # the nearer of both ends of the last cut
            sources[s].shift = a + (k + (2 * lack > words)) * step


@dataclass
class Mix:
    """A solved mix. It gives copies to any row of the documents that it was solved on, from the row alone."""

    sources: dict

    def copies(self, rows: DataFrame) -> DataFrame:
        """rows (doc_id, source, size and others) with source_size, target, rate and copies."""
        if not self.sources:
            return rows.selectExpr("*", "size source_size", "double(0) target", "double(0) rate", "bigint(0) copies")
        found = copies_of(rows, self.sources)
        number = F.col("whole") + F.when(F.col("key") < F.col("shift"), 1).otherwise(0)
        found = found.withColumn("copies", number.cast("long")).drop("tilt", "scale", "flat", "shift", "whole", "key")
        return _with(found, self.sources, {"source_size": lambda x: x.words, "target": lambda x: x.target}).withColumn("source_size", F.col("source_size").cast("long"))


def sized(documents: DataFrame) -> DataFrame:
    """doc_id, source, size of each document, read once and kept in the shared folder."""
    return stored(documents.select("doc_id", F.col("source").cast("string").alias("source"), size(F.col("text")).alias("size")), "sizes")


def solved(sizes: DataFrame) -> Mix:
    per = sizes.groupBy("source").agg(F.sum("size").alias("words"), F.sum(F.col("size").cast("double") * F.col("size")).alias("squares")).collect()
    wanted = targets({r["source"]: r["words"] for r in per})
    sources = {r["source"]: Source(r["words"], wanted[r["source"]], r["squares"] / r["words"] if r["words"] else 1.0) for r in per}
    if sources:
        solve(stored(sizes.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram"), sources)
        balance(sizes, sources)
    return Mix(sources)


def mix(documents: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies: one row for each row of documents."""
    sizes = sized(documents)
    return solved(sizes).copies(sizes)


def repeated(documents: DataFrame) -> DataFrame:
    """The rows of documents, each as often as the mix takes it; columns unchanged.

    Documents without words stay once, unless the mix has no words at all.
    """
    plan = solved(sized(documents))
    own = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("_row")
    rows = documents.select("doc_id", F.col("source").cast("string").alias("source"), size(F.col("text")).alias("size"), own)
    found = plan.copies(rows).filter("copies > 0")
    return found.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")
