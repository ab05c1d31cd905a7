"""Conversation prefix trie: partitions emit partial tries, merged by hash keys, then rolled up from the bottom.

A node is a distinct sequence of turns (role, text) that some conversation starts with; the root has none. Its key is the
XOR of two 64-bit hashes of each turn with its place, so a prefix's key is a running XOR that can be cut anywhere: a
conversation of any length is scanned in ranges, and each range goes on from what came before it. Texts stay where they
were read: only hashes and sizes are shuffled.

    numbered    ranges by conversation and turn, each of bounded size; a conversation that fills many is numbered across them
    rebuilt     each conversation's turns as rebuild() says (its own by default), with keys of nodes and of their parents
    merged      node tables, combined in each task (Spark's partial aggregation) and merged twice: by node and shard, by node
    ended       lists of conversations that end at a node, in pieces by range; their digest is streamed, piece by piece
    rolled_up   sums over subtrees: each round passes sums twice as far up (1, 2, 4 ... levels), so a trie of depth n takes
                about log2(n) rounds, and only nodes at least that deep take part in one

Defined results: null roles and texts are empty; rows of one conversation go by turn (null first), those of one turn by a
hash of role and text, so that ties and repeated rows have one order whatever the partitions; rows without conv_id take no
part; columns besides conv_id, turn, role and text are ignored; an empty table has no node. A digest of a list is sequential
by its nature: the list of one node's ends is read in order by one task, a piece at a time, never held whole.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import forget, in_arrow, stored

#: Rows (hashes and sizes, about 50 bytes each) that a range of the numbering is made for.
RANGE_ROWS = 1 << 18
#: Shards of the first merge.
SHARDS = 16
#: The longest prefix that rebuild() may take from another conversation.
MOST_HEAD = 8
EMPTY = hashlib.sha256(b"").hexdigest()


def lanes(place: Column, a: Column, b: Column) -> tuple[Column, Column]:
    """Two hashes of a turn (its own hashes a and b) at a place."""
    return F.xxhash64(F.lit(3), place, a, b), F.xxhash64(F.lit(5), b, place, a)


def numbered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored rows (part, conv_id, ord, a, b, size), and spans (part, conv_id, before, n): a conversation's rows in each range.

    ord counts from 1 within a span; `before` rows of the conversation lie in earlier ranges.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"), F.octet_length(text).cast("long").alias("size"), F.monotonically_increasing_id().alias("_row")
    )
    parts = max(turns.sparkSession.sparkContext.defaultParallelism, -(-turns.count() // RANGE_ROWS))
    order = ("conv_id", F.asc_nulls_first("turn"), "a", "b", "_row")
    ranged = stored(rows.repartitionByRange(parts, *order).select(F.spark_partition_id().alias("part"), *rows.columns), "trie-ranges")
    within = Window.partitionBy("part", "conv_id").orderBy(*order[1:])
    spans = ranged.groupBy("part", "conv_id").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    placed = stored(ranged.select("part", "conv_id", F.row_number().over(within).cast("long").alias("ord"), "a", "b", "size"), "trie-rows")
    spans = stored(spans, "trie-spans")
    forget(ranged)
    return placed, spans


def own(conv_id: Column) -> tuple[Column, Column]:
    """Each conversation as it is."""
    return conv_id, F.lit(0).cast("long")


def shared_heads(conv_id: Column) -> tuple[Column, Column]:
    """The conversation that gives the head, and how many turns of it: c - c % 5 and crc32(c) % 9."""
    return conv_id - conv_id % 5, F.crc32(conv_id.cast("string")) % 9


def rebuilt(turns: DataFrame, rebuild=own) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """members: part, conv_id, depth, a, b (key), pa, pb (parent's key), size, is_end: a row for each turn of each rebuilt
    conversation; the root's members, likewise with depth 0; and the stored tables that both read."""
    rows, spans = numbered(turns)
    source, head = rebuild(F.col("conv_id"))
    convs = spans.groupBy("conv_id").agg(F.sum("n").alias("n"), F.max("part").alias("last")).withColumns({"source": source, "h": head.cast("long")})
    first = rows.filter(F.col("ord") <= MOST_HEAD).join(spans.filter(F.col("before") < MOST_HEAD).select("part", "conv_id", "before"), ["part", "conv_id"])
    first = first.withColumn("i", F.col("before") + F.col("ord") - 1).filter(F.col("i") < MOST_HEAD)
    heads = first.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("i", *(x.alias(n) for n, x in zip(("x", "y"), lanes(F.col("i"), F.col("a"), F.col("b")), strict=True)), "size"))).alias("head"))
    convs = convs.join(heads.withColumnRenamed("conv_id", "source"), "source", "left")
    given = F.coalesce(F.slice("head", F.lit(1), F.least("h", F.size("head")).cast("int")), F.array().cast(heads.schema["head"].dataType))
    xor = lambda some, lane: F.aggregate(some, F.lit(0).cast("long"), lambda s, x: s.bitwiseXOR(x[lane]))
    convs = convs.withColumn("head", F.when(F.col("h") > 0, given).otherwise(F.slice(given, 1, 0))).withColumn("l", F.size("head").cast("long"))
    convs = convs.withColumns({"x0": xor(F.col("head"), "x"), "y0": xor(F.col("head"), "y"), "depth": F.col("l") + F.greatest(F.col("n") - F.col("h"), F.lit(0))})
    convs = stored(convs.select("conv_id", "last", "h", "l", "x0", "y0", "depth", "head"), "trie-conversations")

    # own turns, after the head: a running XOR in each span, then what earlier spans of the conversation come to
    told = rows.join(spans.select("part", "conv_id", "before").join(convs.drop("head", "last"), "conv_id"), ["part", "conv_id"])
    place = F.col("before") + F.col("ord") - 1
    told = told.filter(place >= F.col("h")).withColumn("i", F.col("l") + place - F.col("h"))
    x, y = lanes(F.col("i"), F.col("a"), F.col("b"))
    so_far = Window.partitionBy("part", "conv_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    told = told.withColumns({"x": x, "y": y}).withColumns({"rx": F.bit_xor("x").over(so_far), "ry": F.bit_xor("y").over(so_far)})
    run = stored(told.select("part", "conv_id", (F.col("i") + 1).alias("depth"), "x", "y", "rx", "ry", "x0", "y0", "size", (F.col("i") + 1 == F.col("depth")).alias("is_end")), "trie-runs")
    totals = run.groupBy("part", "conv_id").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select("part", "conv_id", F.bit_xor("x").over(earlier).alias("cx"), F.bit_xor("y").over(earlier).alias("cy")).filter("cx is not null")
    # at most one conversation of a range goes on from an earlier one: no more rows than ranges
    after = run.join(F.broadcast(carry), ["part", "conv_id"], "left")
    key = {n: F.col(f"r{c}").bitwiseXOR(F.col(f"{c}0")).bitwiseXOR(F.coalesce(F.col(f"c{c}"), F.lit(0).cast("long"))) for n, c in (("a", "x"), ("b", "y"))}
    after = after.withColumns(key).select("part", "conv_id", "depth", "a", "b", F.col("a").bitwiseXOR(F.col("x")).alias("pa"), F.col("b").bitwiseXOR(F.col("y")).alias("pb"), "size", "is_end")
    upto = lambda lane, k: xor(F.slice("head", F.lit(1), k), lane)
    steps = F.transform(
        "head",
        lambda t, k: F.struct((k + 1).cast("long").alias("depth"), upto("x", k + 1).alias("a"), upto("y", k + 1).alias("b"), upto("x", k).alias("pa"), upto("y", k).alias("pb"), t["size"].alias("size")),
    )
    taken = convs.select(F.col("last").alias("part"), "conv_id", F.col("depth").alias("whole"), F.explode(steps).alias("s")).select("part", "conv_id", "s.*", (F.col("s.depth") == F.col("whole")).alias("is_end"))
    zero = F.lit(0).cast("long")
    root = convs.select(F.col("last").alias("part"), "conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b"), F.lit(None).cast("long").alias("pa"), F.lit(None).cast("long").alias("pb"), zero.alias("size"), (F.col("depth") == 0).alias("is_end"))
    return after.unionByName(taken), root, [rows, spans, convs, run]


def merged(members: DataFrame) -> DataFrame:
    """One row for each node: its key, parent's key, depth, size of the last text, n_convs and conv_id (the smallest member)."""
    shared = lambda *more: [F.first("pa").alias("pa"), F.first("pb").alias("pb"), F.first("depth").alias("depth"), F.first("size").alias("size"), *more]
    some = members.groupBy("a", "b", F.pmod("conv_id", F.lit(SHARDS)).alias("shard")).agg(*shared(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")))
    return some.groupBy("a", "b").agg(*shared(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id")))


def ended(members: DataFrame) -> DataFrame:
    """a, b, ends_sha256 of nodes where a conversation ends: the digest of the ids, ascending, with commas between."""
    pieces = members.filter("is_end").groupBy("a", "b", "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    pieces = pieces.repartition("a", "b").sortWithinPartitions("a", "b", "part").select("a", "b", "ids")

    def run(batches):
        at, state = None, None
        for batch in batches:
            found = []
            for a, b, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if at == (a, b):
                    state.update(b"," + ids.encode())
                    continue
                if at is not None:
                    found.append((*at, state.hexdigest()))
                at, state = (a, b), hashlib.sha256(ids.encode())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=["a", "b", "ends_sha256"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*at, state.hexdigest())], names=["a", "b", "ends_sha256"])

    return in_arrow(pieces, run, "a long, b long, ends_sha256 string")


def rolled_up(nodes: DataFrame, sums: list[str]) -> tuple[DataFrame, list[DataFrame]]:
    """a, b and the sums of each node's subtree (its top included), and the stored tables that they read.

    Before a round of reach r, each node deep enough has the sums of its descendants less than r levels below, and knows its
    ancestor r levels above. It gives that ancestor its sums, and learns the ancestor's own ancestor.
    """
    own_ = nodes.select("a", "b", *sums)
    alive = nodes.filter("depth >= 1").select("a", "b", "depth", F.col("pa").alias("ja"), F.col("pb").alias("jb"), *sums)
    deepest, reach, given, kept = nodes.agg(F.max("depth")).first()[0] or 0, 1, [own_], []
    while reach <= deepest:
        gift = stored(alive.groupBy(F.col("ja").alias("a"), F.col("jb").alias("b")).agg(*(F.sum(s).alias(s) for s in sums)), f"trie-gifts-{reach}")
        given.append(gift)
        kept.append(gift)
        if 2 * reach <= deepest:
            above = alive.select(F.col("a").alias("ja"), F.col("b").alias("jb"), F.col("ja").alias("fa"), F.col("jb").alias("fb"))
            more = gift.select("a", "b", *(F.col(s).alias(f"_{s}") for s in sums))
            deep = alive.filter(F.col("depth") >= 2 * reach).join(more, ["a", "b"], "left").join(above, ["ja", "jb"])
            total = ((F.col(s) + F.coalesce(F.col(f"_{s}"), F.lit(0))).alias(s) for s in sums)
            alive = stored(deep.select("a", "b", "depth", F.col("fa").alias("ja"), F.col("fb").alias("jb"), *total), f"trie-alive-{reach}")
            kept.append(alive)
        reach *= 2
    every = given[0]
    for more in given[1:]:
        every = every.unionByName(more)
    return every.groupBy("a", "b").agg(*(F.sum(s).alias(s) for s in sums)), kept


def trie(turns: DataFrame, rebuild=own) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    rebuild(conv_id) tells which conversation gives each one's first turns, and how many (MOST_HEAD at most).
    """
    members, root, tables = rebuilt(turns, rebuild)
    everyone = members.unionByName(root)
    merges = stored(merged(everyone), "trie-merged")
    children = merges.filter("pa is not null").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    nodes = merges.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("size")})
    nodes = stored(nodes.join(ended(everyone), ["a", "b"], "left"), "trie-nodes")
    forget(*tables, merges)
    sums, kept = rolled_up(nodes, ["n_leaves", "saved_tokens"])
    above = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    told = nodes.drop("n_leaves", "saved_tokens").join(sums, ["a", "b"]).join(above, ["pa", "pb"], "left")
    out = stored(
        told.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256")), "trie"
    )
    forget(nodes, *kept)
    return out
