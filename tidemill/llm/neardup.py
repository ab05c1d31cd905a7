"""MinHash near-dedup: DartMinHash signatures, joined by bands, checked exactly, and closed to classes.

Texts are sets of five-word shingles; with `weighted` they are multisets, in which a shingle weighs as often as it occurs.
Equal texts become one group at once. Groups whose signatures agree in a band meet in a bucket, and a pair is a link if its
exact similarity is at least the threshold. Classes are the connected components of all links.

No bucket is capped. Each member is compared with the bucket's leader; members that this joins are one class and need no
more comparing among themselves. Where a bucket still holds several classes, rows outside its largest class are compared
with all others, if it is small. Rows of large buckets meet again by their rarest shingles, of which any two linked sets
share one; rows of the largest class take part only if their size lets them link to a row outside it. There the row with
the fewest elements before the shared one leads first, as others most likely differ from it alone; then rows outside the
largest class are compared with all whose sizes and places in the order of rarity leave room for a link. What one bucket
has to compare is dealt out to tasks of about BLOCK comparisons each.

So the classes are those of all pairs that meet in a bucket; with 24 bands of 5 a pair of similarity 0.8 misses all
buckets with probability 7e-5, one of 0.85 with 8e-7. Lower thresholds take bands for which a pair at the threshold misses
all buckets with probability MISS at most.

The driver sees counts only, and CELLS numbers that rank shingles by how frequent they are. Tables between steps are
written to the shared folder, which cuts the lineage, and deleted when no step needs them any more. What is broadcast is
counted first: beyond BROADCAST bytes the join shuffles, and AQE splits the partitions of hot keys.

Defined results: null texts are empty texts; all empty texts are one class. Texts without five words match only texts
of the same words. class_id is the smallest doc_id of a class (null if it has none). Rows that repeat, or that share a
doc_id with another text, are rows of their own. Further columns, whatever their names, don't matter to classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm import darts
from tidemill.llm.common import bounded, forget, in_arrow, slices, stored, unused

BANDS, ROWS, WIDTH, LEAST = 24, 5, 5, 0.8
#: For thresholds below LEAST: the probability that a pair at the threshold shares no band, and about how long a signature may get for longer rows.
MISS, LONGEST = 1e-4, 512
#: Rows up to which a bucket counts as small, comparisons of a task, and cells that shingles are counted in to rank them.
SMALL, BLOCK, CELLS = 64, 1 << 18, 1 << 16
#: Rows of a tile's side.
SIDE = 512
#: Partial counts that are added up side by side.
FAN = 32


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def banding(least: float) -> tuple[int, int]:
    """Bands, and rows of each, that serve this threshold; rows are fewer where many would take too many bands."""
    if not 0 < least <= 1:
        raise ValueError(f"a threshold of similarity is above 0 and at most 1, not {least}")
    if least >= LEAST:
        return BANDS, ROWS
    for rows in range(ROWS, 0, -1):
        bands = math.ceil(math.log(MISS) / math.log1p(-(least**rows)))
        if bands * rows <= LONGEST or rows == 1:
            return bands, rows


def signed(documents: DataFrame, weighted: bool = False, least: float = LEAST) -> DataFrame:
    """doc_id, key (of the text), n (shingles, repeats counted if weighted), bands: one narrow pass over whole texts."""
    schema = T.StructType([documents.schema["doc_id"], T.StructField("key", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    n_bands, n_rows = banding(least)

    def run(batches):
        for part, texts in slices(batches, "text", 1 << 18):
            text, shingle, often = darts.shingles(texts, WIDTH)
            weights = often.astype(float) if weighted else np.ones(len(text))
            keys = darts.banded(darts.signatures(text, shingle, weights, len(texts), n_bands * n_rows), n_rows)
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * n_bands, pa.int32()), pa.array(keys.ravel()))
            n = np.bincount(text, weights=weights, minlength=len(texts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("key").cast(pa.binary()), pa.array(n), bands], names=schema.names)

    return in_arrow(documents.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("key", text_key(F.col("text"))), run, schema)


def shingled(documents: DataFrame, weighted: bool = False) -> DataFrame:
    """key, s: the 64-bit hashes of the shingles; if weighted, one for each time that a shingle occurs."""
    schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("s", T.ArrayType(T.LongType()))])

    def run(batches):
        for part, texts in slices(batches, "text", 1 << 18):
            text, shingle, often = darts.shingles(texts, WIDTH)
            if weighted:
                text, shingle = darts.occurrences(text, shingle, often)
            at = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([part.column("key").cast(pa.binary()), pa.ListArray.from_arrays(at, pa.array(shingle.view(np.int64)))], names=schema.names)

    return in_arrow(documents.select("key", "text"), run, schema)


def links(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of pairs (a, b) that are at least so similar, by exact comparison of their sets."""
    both = pairs.join(sets.select(F.col("rid").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("rid").alias("b"), F.col("s").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.filter(shared >= F.lit(least) * (F.size("x") + F.size("y") - shared) - 1e-9).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """rid, label (the smallest rid of its component) for all ends of edges (a, b).

    Each round sends every vertex to its smallest neighbour, follows that twice, and contracts the edges; the number of
    rounds grows with the logarithm of the longest chain. Tables between rounds are written, so lineage stays short.
    """
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("p")), "step")
        to = lambda of, name: near.select(F.col("v").alias(of), F.col("p").alias(name))
        jumped = near.join(to("p", "q"), "p", "left").join(to("q", "r"), "q", "left")
        step = stored(jumped.select("v", F.coalesce("r", "q", "p").alias("p")), "jump")
        before, old = edges, labels
        labels = stored(step.select(F.col("v").alias("rid"), F.col("p").alias("label")) if old is None else relabelled(old, step), "labels")
        to = step.select("v", "p")
        ends = edges.join(to.toDF("a", "p"), "a").join(to.toDF("b", "q"), "b").filter("p != q")
        edges = stored(ends.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct(), "edges")
        forget(before, near, step, *([] if old is None else [old]))
    return labels if labels is not None else edges.select(F.col("a").alias("rid"), F.col("b").alias("label"))


def relabelled(labels: DataFrame, step: DataFrame) -> DataFrame:
    """labels (rid, label) after each label v has become p."""
    return labels.join(step.select(F.col("v").alias("label"), "p"), "label", "left").select("rid", F.coalesce("p", "label").alias("label"))


def merged(found: DataFrame, new: DataFrame) -> DataFrame:
    """found (rid, label) with further edges (a, b): only these are solved, on the labels of their ends."""
    names = found.select(F.col("rid").alias("_rid"), "label")
    ends = new.join(names.toDF("a", "p"), "a", "left").join(names.toDF("b", "q"), "b", "left")
    step = components(ends.select(F.coalesce("p", "a").alias("a"), F.coalesce("q", "b").alias("b")).filter("a != b"))
    step = step.select(F.col("rid").alias("v"), F.col("label").alias("p"))
    alone = step.join(found.select(F.col("rid").alias("v")), "v", "left_anti").select(F.col("v").alias("rid"), F.col("p").alias("label"))
    return stored(relabelled(found, step).unionByName(alone), "labels")


def classes(documents: DataFrame, least: float = LEAST, weighted: bool = False) -> DataFrame:
    """doc_id, key, class_id, rep_id and rep_key (doc_id and key of the row that stands for the class): a row for each of documents."""
    signs = stored(signed(documents, weighted, least), "signatures")
    groups = signs.groupBy("key").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    groups = stored(groups.withColumn("rid", F.monotonically_increasing_id()), "groups")
    spread = groups.select("rid", "n", F.explode("bands").alias("bucket"))
    leaders = spread.groupBy("bucket").agg(F.min(F.struct("rid", "n")).alias("lead"), F.count("*").alias("size")).filter("size > 1")
    members = stored(spread.join(leaders, "bucket").select("bucket", "rid", "n", F.col("lead.rid").alias("leader"), F.col("lead.n").alias("leader_n")), "members")
    needed = stored(members.select("rid").distinct().join(groups.select("rid", "doc", "key"), "rid"), "needed")
    many = needed.count()
    if not many:
        found = groups.select("rid", F.lit(None).cast("long").alias("label"))
    else:
        own = needed.select(F.col("doc").alias("_doc")).distinct()
        texts = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        texts = texts.join(bounded(own, many, 48), texts["doc_id"].eqNullSafe(own["_doc"]), "left_semi").withColumn("key", text_key(F.col("text"))).select("key", "text")
        sets = shingled(texts, weighted).join(bounded(needed.select("key", "rid"), many, 112), "key").dropDuplicates(["rid"])
        sets = stored(sets.select("rid", "s"), "sets")
        by_leader = members.filter("rid != leader").select(F.col("rid").alias("a"), F.col("n").alias("n_a"), F.col("leader").alias("b"), F.col("leader_n").alias("n_b"))
        found = components(links(pruned(by_leader, least), sets, least))
        found = unsettled(members.select("bucket", "rid", "n"), found, sets, least)
        forget(members, needed, sets)
    named = groups.join(found, "rid", "left").select("key", "doc", F.coalesce("label", "rid").alias("label"))
    heads = named.groupBy("label").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "key")).alias("rep"))
    named = named.join(heads, "label").select("key", F.col("rep.doc").alias("class_id"), F.col("rep.key").alias("rep_key"))
    return signs.select("doc_id", "key").join(named, "key").select("doc_id", "key", "class_id", F.col("class_id").alias("rep_id"), "rep_key")


def unsettled(members: DataFrame, found: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """found (rid, label) after all rows (bucket, rid, n) that share a bucket and have different labels were compared."""
    rest = stored(apart(members, found, least), "rest")
    if rest.isEmpty():
        return found
    few = F.col("size") <= SMALL
    large = stored(rest.filter(~few).select("rid", "n").distinct(), "large")
    if large.isEmpty():
        return compared(found, across(rest, least), sets, least)
    rarest = stored(by_rarest(large, sets, least), "rarest")
    found = settled(rarest, found, sets, least, across(rest.filter(few), least))
    forget(rest, large, rarest)
    return found


def compared(found: DataFrame, pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """found (rid, label) after these pairs (a, b) were compared."""
    new = stored(links(pairs.select("a", "b").distinct(), sets, least), "links")
    return found if new.isEmpty() else merged(found, new)


def settled(buckets: DataFrame, found: DataFrame, sets: DataFrame, least: float, more: DataFrame | None = None) -> DataFrame:
    """found (rid, label) after all rows (bucket, rid, n, at) that share a bucket and have different labels were compared, and more pairs.

    In each bucket one row leads first; what it does not join is then compared with all that sizes and places allow.
    """
    again, leads = stored(apart(buckets, found, least), "again"), F.col("rid") == F.col("head")
    first = across(again, least, leads)
    found = compared(found, first if more is None else first.unionByName(more), sets, least)
    # the rows that led have met all others of their buckets
    left = stored(apart(again.filter(~leads).select("bucket", "rid", "n", "at"), found, least), "rest")
    if not left.isEmpty():
        found = compared(found, across(left, least), sets, least)
    forget(again, left)
    return found


def apart(rows: DataFrame, found: DataFrame, least: float = LEAST) -> DataFrame:
    """Those of rows (bucket, rid, n, at) that a link to another class of their bucket is possible for, with label, size and top
    (rows of the bucket and of its largest class), lead (that class) and head (the row with the fewest elements before the bucket's).

    at, the number of elements before the bucket's own in the order that made the buckets, is 0 where there is none. A
    row goes if it can't reach the similarity even with the bucket's smallest set, or if it is of the largest class and no
    row outside that class has a size near enough.
    """
    rows = rows.withColumn("at", rows["at"] if "at" in rows.columns else F.lit(0)).join(found, "rid", "left").select("bucket", "rid", "n", "at", F.coalesce("label", "rid").alias("label"))
    tally = rows.groupBy("bucket", "label").agg(F.count("*").alias("c"), F.min("n").alias("low"), F.max("n").alias("high"), F.min(F.struct("at", "rid")).alias("head"))
    several = tally.groupBy("bucket").agg(
        F.sum("c").alias("size"), F.max("c").alias("top"), F.max(F.struct("c", "label")).alias("lead"), F.count("*").alias("kinds"), F.min("low").alias("low"), F.min("head").alias("head")
    )
    several = several.filter("kinds > 1").select("bucket", "size", "top", F.col("lead.label").alias("lead"), "low", F.col("head.rid").alias("head"))
    outside = tally.join(several.select("bucket", "lead"), "bucket").filter("label != lead").groupBy("bucket").agg(F.min("low").alias("from"), F.max("high").alias("to"))
    several = stored(several.join(outside, "bucket"), "several")
    fits = F.col("n") - F.col("at") >= shared_at_least("n", F.greatest(F.col("low"), least * F.col("n")), least)
    near = (F.col("label") != F.col("lead")) | (F.col("n") >= least * F.col("from") - 1e-6) & (least * F.col("n") <= F.col("to") + 1e-6)
    return rows.join(bounded(several, several.count(), 96), "bucket").filter(fits & near).drop("low", "from", "to")


def shared_at_least(n: Column | str, m: Column | str, least: float) -> Column:
    """How many elements sets of these sizes share at such a similarity."""
    n, m = (F.col(x) if isinstance(x, str) else x for x in (n, m))
    return F.lit(least / (1 + least)) * (n + m) - 1e-6


def across(buckets: DataFrame, least: float, leads: Column | None = None) -> DataFrame:
    """Pairs of different classes within buckets, of rows outside the largest class (or that `leads` marks) with all others.

    Sizes must allow the similarity, and so must places: if the bucket's element is the first that two sets share, no
    more than what follows it can be shared; if it is not, they meet in the bucket of the first. A bucket's rows are dealt
    out by a hash, and so are those that are compared with all of them; what meets is a tile of both, of about BLOCK
    comparisons. Either side is copied as often as the other has parts: n rows and m of them make 2nm / SIDE copies at most.
    """
    times = F.col("size") - F.col("top") if leads is None else F.lit(1)
    sides = F.ceil(times / F.lit(SIDE)).cast("int")
    parts = F.ceil(F.col("size") * times / (F.lit(BLOCK) * sides)).cast("int")
    every = buckets.select("*", F.pmod(F.xxhash64("rid"), parts).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), sides - 1)).alias("side"))
    one = (buckets.filter("label != lead") if leads is None else buckets.filter(leads)).select(
        F.col("bucket").alias("bucket_r"), F.col("rid").alias("r"), F.col("n").alias("n_r"), F.col("at").alias("at_r"), F.col("label").alias("label_r"), F.pmod(F.xxhash64("rid", F.lit(7)), sides).cast("int").alias("side_r"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part_r")
    )
    need = shared_at_least("n", "n_r", least)
    meet = (F.col("label") != F.col("label_r")) & (F.least("n", "n_r") >= least * F.greatest("n", "n_r") - 1e-6) & (F.least(F.col("n") - F.col("at"), F.col("n_r") - F.col("at_r")) >= need)
    if leads is None:
        meet &= (F.col("label") == F.col("lead")) | (F.col("rid") < F.col("r"))
    same = (every["bucket"] == one["bucket_r"]) & (every["part"] == one["part_r"]) & (every["side"] == one["side_r"])
    return every.join(one, same & meet).select(F.least("rid", "r").alias("a"), F.greatest("rid", "r").alias("b"))


def cell(elements: np.ndarray) -> np.ndarray:
    return (elements.view(np.uint64) >> np.uint64(20)).astype(np.int64) % CELLS


def elements_of(batch: pa.RecordBatch, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """From which to which row, their elements, and where each row's start; parts hold about `most` elements (one row at least)."""
    lists = batch.column("s")
    at = np.asarray(lists.offsets).astype(np.int64)
    flat = np.asarray(lists.values)
    i = 0
    while i < len(lists):
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, side="right")) - 1)
        yield i, j, flat[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def frequencies(rows: DataFrame) -> np.ndarray:
    """How many elements of all rows' s fall into each of CELLS cells: counted in each partition, added up FAN at a time."""

    def count(batches):
        n = np.zeros(CELLS, np.int64)
        for batch in batches:
            for _, _, flat, _ in elements_of(batch):
                n += np.bincount(cell(flat), minlength=CELLS)
        yield pa.RecordBatch.from_arrays([pa.array([n.tobytes()], pa.binary())], names=["n"])

    def add(batches):
        n = np.zeros(CELLS, np.int64)
        for batch in batches:
            for x in batch.column("n"):
                n += np.frombuffer(x.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([n.tobytes()], pa.binary())], names=["n"])

    parts = in_arrow(in_arrow(rows.select("s"), count, "n binary").repartition(FAN), add, "n binary").collect()
    return np.sum([np.frombuffer(r["n"], np.int64) for r in parts], axis=0)


def by_rarest(rows: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Other buckets for the same rows (rid, n): the rarest elements of each, one of which any two linked sets share.

    Sets of similarity t have one of the first n - ceil(t * n) + 1 elements of either in common, in any one order of all
    elements. Here it is that of the count of an element's cell, then of its hash: what many texts share comes last and
    hardly ever gathers them. `at` is an element's place. An element that is alone in its cell gathers nothing and is left out.
    """
    own = sets.join(bounded(rows, rows.count(), 48), "rid").select("rid", "n", "s")
    often = own.sparkSession.sparkContext.broadcast(frequencies(own))

    def run(batches):
        for batch in batches:
            rid, n = batch.column("rid").to_numpy(), batch.column("n").to_numpy()
            for i, j, flat, at in elements_of(batch):
                sizes = np.diff(at)
                row = np.repeat(np.arange(j - i), sizes)
                count = often.value[cell(flat)]
                order = np.lexsort((flat, count, row))
                place = np.arange(len(flat)) - np.repeat(at[:-1], sizes)
                room = sizes - np.ceil(least * sizes - 1e-9).astype(np.int64) + 1
                first = order[(place < room[row]) & (count[order] > 1)]
                where = place[(place < room[row]) & (count[order] > 1)]
                yield pa.RecordBatch.from_arrays([pa.array(flat[first]), pa.array(rid[i + row[first]]), pa.array(n[i + row[first]]), pa.array(where)], names=["bucket", "rid", "n", "at"])

    return in_arrow(own, run, "bucket long, rid long, n long, at long")


def pruned(pairs: DataFrame, least: float) -> DataFrame:
    """Distinct pairs whose sizes allow the similarity."""
    fits = F.least("n_a", "n_b") >= F.lit(least) * F.greatest("n_a", "n_b") - 1e-9
    return pairs.filter(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def one_of_each(documents: DataFrame, least: float = LEAST) -> DataFrame:
    """documents without all but one row of each class: the row of the smallest doc_id; columns unchanged, whatever their names."""
    # written before it is counted: a join that feeds a count by the same key could not be split where many texts are equal
    every = stored(classes(documents, least), "classes")
    rows = stored(every.groupBy("doc_id", "key", "rep_id", "rep_key").agg(F.count("*").alias("n")), "rows")
    forget(every)
    key, gone_id, gone_key = (unused(documents.columns, x) for x in ("_key", "_gone_id", "_gone_key"))
    stays = F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("key") == F.col("rep_key"))
    named = (F.col("doc_id").alias(gone_id), F.col("key").alias(gone_key))
    gone, twice = rows.filter(~stays | (F.col("n") > 1)).select(*named), rows.filter(stays & (F.col("n") > 1)).select(*named)
    marked = documents.withColumn(key, text_key(F.col("text").cast("string")))
    same = lambda other: marked["doc_id"].eqNullSafe(other[gone_id]) & (marked[key] == other[gone_key])
    out = marked.join(bounded(gone, gone.count(), 112), same(gone), "left_anti")
    if not twice.isEmpty():
        out = out.unionByName(marked.join(bounded(twice, twice.count(), 112), same(twice), "left_semi").dropDuplicates(["doc_id", key]))
    return out.drop(key)
