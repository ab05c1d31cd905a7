"""Document fingerprints: SpotSigs.

A signature is a common word (the anchor) and the chain of the next content words after it; a document's fingerprint is
the set of its signatures, as sorted 32-bit hashes. Text that a page carries besides its prose (menus, lists) has few
anchors, so it adds few signatures. The likeness of two fingerprints is the Jaccard similarity of their sets.

similar() joins a whole table with itself: fingerprints are partitioned by set length (only lengths within the
threshold can match), and within neighbouring partitions by the rarest signatures, of which a matching pair must share
one; what is left is compared through a pruned Jaccard. Equal fingerprints are members of one class, and so are those that
links join; classes are never expanded into pairs.

Defined results: a null text is empty; an empty text, or one without a word, has the empty fingerprint; a text with words but
without a whole chain has one signature, of all its words. Two empty fingerprints are alike (1.0), an empty one and
another are not (0.0). Documents go by doc_id descending, null last, rows of one doc_id by text; the next of the last
is the first, and that of a single document is itself.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm import neardup
from tidemill.llm.common import in_arrow, local, slices, stored

# Frequent function words of English, German, French and Spanish.
ANCHORS = frozenset(
    """a an and are as at be but by for from has have he in is it of on or she that the they this to was were which will with you not
    der die das den dem des ein eine einer und ist sind war im mit von zu auf nicht sich als auch für es
    le la les un une des du de et est sont dans en au aux par pour que qui sur avec pas ne ce
    el los las una unos y es son se por con del al lo su para como más no""".split()
)
CHAIN = 2
WORD = re.compile(r"[^\W_]+")


def signatures(text: str, chain: int = CHAIN) -> set[int]:
    words = WORD.findall(text.lower())
    content: list[str] = []
    spots: list[tuple[str, int]] = []
    add, spot, common = content.append, spots.append, ANCHORS
    for w in words:
        if w in common:
            spot((w, len(content)))
        else:
            add(w)
    last = len(content) - chain
    crc = zlib.crc32
    found = {crc(f"{a} {' '.join(content[i : i + chain])}".encode("utf-8", "replace")) for a, i in spots if i <= last}
    if not found and words:
        found = {crc(" ".join(words).encode("utf-8", "replace"))}
    return found


def fingerprint(found: set[int]) -> str:
    return ",".join(["%08x" % x for x in sorted(found)])


def likeness(a: set[int], b: set[int], least: float = 0.0) -> float:
    """Jaccard similarity; 0.0 without counting if set lengths alone keep it below `least`."""
    if not a and not b:
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    if len(a) < least * len(b):
        return 0.0
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def prints(documents: DataFrame) -> DataFrame:
    """doc_id, n_signatures, fingerprint: one narrow pass."""
    schema = T.StructType([documents.schema["doc_id"], T.StructField("n_signatures", T.IntegerType()), T.StructField("signatures", T.ArrayType(T.LongType()))])

    def run(batches):
        for part, texts in slices(batches, "text"):
            found = [sorted(signatures(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(map(len, found), pa.int32()), pa.array(found, pa.list_(pa.int64()))], names=schema.names)

    return in_arrow(documents.select("doc_id", F.col("text").cast("string").alias("text")), run, schema)


def similar(documents: DataFrame, least: float = 0.8) -> DataFrame:
    """doc_id, class_id: documents whose fingerprints are linked, directly or through others, by that much likeness.

    Two sets of likeness t share one of the first n - ceil(t * n) + 1 signatures of each, in any fixed order (here from rare to
    frequent), and their lengths fall into the same or neighbouring length classes, each a factor t wide; so a row of either
    meets the other in a bucket of signature and length class. Within buckets sets that sizes and places allow are compared (the
    pruned Jaccard), first with one that leads: what it joins needs no more comparing. Equal fingerprints are one set.
    """
    own = stored(prints(documents).withColumn("key", F.sha2(F.concat_ws(",", F.col("signatures").cast("array<string>")), 256)), "spots")
    sets = own.groupBy("key").agg(F.min("doc_id").alias("doc"), F.first("n_signatures").cast("long").alias("n"), F.first("signatures").alias("s"))
    sets = stored(sets.withColumn("rid", F.monotonically_increasing_id()), "spot-sets")
    full = sets.filter("n > 0").select("rid", "n", "s")
    length = F.floor(F.log("n") / -math.log(least) + 1e-9) if least < 1 else F.col("n")
    rows = neardup.by_rarest(full.select("rid", "n"), full.select("rid", "s"), least)
    rows = rows.select(F.explode(F.array(length, length + 1)).alias("part"), "bucket", "rid", "n", "at").select(F.xxhash64("bucket", "part").alias("bucket"), "rid", "n", "at")
    rows, none = stored(rows, "spot-buckets"), full.select("rid", F.col("rid").alias("label")).limit(0)
    found = neardup.settled(rows, none, full, least)
    named = sets.join(found, "rid", "left").select("key", "doc", F.coalesce("label", "rid").alias("label"))
    heads = named.groupBy("label").agg(F.min("doc").alias("class_id"))
    return own.select("doc_id", "key").join(named.join(heads, "label").select("key", "class_id"), "key").select("doc_id", "class_id")


#: Bytes of the input, as Spark estimates them from its files, that one of compare()'s partitions is made for.
PART_BYTES = 8 << 20
#: Beyond so many partitions they grow instead (the estimate of a table without files is no use).
MOST_PARTS = 20_000
#: Cuts that a row is compared with at a time to find its partition.
STRIDE = 128


def parts_of(documents: DataFrame) -> int:
    """How many partitions documents are worth, by their size; as many as there are cores at least."""
    size = int(documents.select("doc_id", "text")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(documents.sparkSession.sparkContext.defaultParallelism, min(-(-size // PART_BYTES), MOST_PARTS))


def in_order(documents: DataFrame, parts: int) -> DataFrame:
    """doc_id, text, _kind in `parts` partitions that follow each other by descending doc_id, sorted within.

    _kind 0: the partition's own rows; 1 and 2: copies of the rows that come next after them. One shuffle of the texts;
    the driver holds one doc_id for each partition.
    """
    spark = documents.sparkSession
    rows = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shares = [i / parts for i in range(1, parts)]
    cuts = (rows.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 10 * parts).alias("q")).first()["q"] if shares else None) or []
    kind, cuts = rows.schema["doc_id"].dataType.simpleString(), sorted(set(cuts))
    listed = lambda some: F.array(*map(F.lit, some)).cast(f"array<{kind}>")
    below = lambda some: F.size(F.filter(some, lambda c: c <= F.col("doc_id")))
    # the number of cuts at or below doc_id, in two steps; null comes last of all, with the smallest
    coarse = F.greatest(below(listed(cuts[::STRIDE])) - 1, F.lit(0)) * STRIDE
    rows = rows.withColumn("_coarse", coarse).withColumn("_part", F.when(F.col("doc_id").isNull(), 0).otherwise(F.col("_coarse") + below(F.slice(listed(cuts), F.col("_coarse") + 1, F.lit(STRIDE)))))
    tops = sorted(rows.groupBy("_part").agg(F.max("doc_id").alias("top")).collect(), key=lambda r: r["_part"])
    ghosts = [(r["top"], tops[i + 1]["_part"], 1) for i, r in enumerate(tops[:-1])] + [(r["top"], tops[0]["_part"], 2) for r in tops[-1:]]
    if not ghosts:
        return rows.selectExpr("doc_id", "text", "0 _kind")
    table = F.broadcast(local(spark, ghosts, T.StructType([T.StructField("_top", rows.schema["doc_id"].dataType), T.StructField("_to", T.IntegerType()), T.StructField("_as", T.IntegerType())])).groupBy("_top").agg(F.collect_list(F.struct("_to", "_as")).alias("_ghosts")))
    own = F.array(F.struct(F.col("_part").alias("_to"), F.lit(0).alias("_as")))
    rows = rows.join(table, rows["doc_id"].eqNullSafe(table["_top"]), "left")
    rows = rows.select("doc_id", "text", F.explode(F.concat(own, F.coalesce("_ghosts", F.array().cast("array<struct<_to:int,_as:int>>")))).alias("_at"))
    rows = rows.select("doc_id", "text", F.col("_at._to").alias("_part"), F.col("_at._as").alias("_kind"))
    placed = rows.repartitionById(max(parts, 1), F.col("_part"))
    return placed.sortWithinPartitions("_kind", F.desc_nulls_last("doc_id"), "text").select("doc_id", "text", "_kind")


def edited(text: str, after: str) -> str:
    """text with its last half replaced by as much of the beginning of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def compare(documents: DataFrame, parts: int) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how like it are the edited text's and the next one's."""
    fields = (("n_chars", T.LongType()), ("edited_sha256", T.StringType()), ("fingerprint", T.StringType()), ("edited_fingerprint", T.StringType()), ("near_edited", T.DoubleType()), ("near_next", T.DoubleType()))
    schema = T.StructType([documents.schema["doc_id"], *(T.StructField(n, k) for n, k in fields)])
    kind_of = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.DoubleType(): pa.float64()}

    def run(batches):
        held, id_type = None, None  # the row that waits for its next one: doc_id, text, signatures
        rows: list[tuple] = []

        def flush():
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), *(pa.array(c, kind_of[k]) for c, (_, k) in zip(columns[1:], fields, strict=True))], names=schema.names)

        for part, texts in slices(batches, "text"):
            id_type = part.schema.field("doc_id").type
            for doc_id, kind, text in zip(part.column("doc_id").to_pylist(), part.column("_kind").to_pylist(), texts, strict=True):
                if held is None and kind:
                    continue
                now = (doc_id, text, signatures(text))
                if held is not None:
                    mixed = edited(held[1], text)
                    other = signatures(mixed)
                    digest = hashlib.sha256(mixed.encode("utf-8", "replace")).hexdigest()
                    rows.append((held[0], len(held[1]), digest, fingerprint(held[2]), fingerprint(other), likeness(held[2], other), likeness(held[2], now[2])))
                held = None if kind else now
            if rows:
                yield flush()
                rows.clear()

    return in_arrow(in_order(documents, parts), run, schema)
