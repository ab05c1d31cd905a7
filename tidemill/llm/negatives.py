"""Hard-negative mining: product quantisation with stored residual norms, exact integer rerank.

A vector is cut into stretches of SUB components; each stretch is coded by the nearest of CODES centroids, and the norm of
what the centroid leaves over is stored beside the code. For an anchor, the sum of looked-up products of its stretches with
the centroids is a score, and the sum of its stretches' norms times the stored norms bounds how far the true inner product
lies from it. Whatever that interval shows to be outside of a window, or below what is held already, is left; everything
else is scored exactly, in integers. The bound is rigorous, so results are those of brute force: recall is 1.

    rows       vec_id, label, v: integer components as bytes; what takes part
    indexed    rows with codes and residual norms, centroids being fitted on a bounded sample (SAMPLE rows); stored once
    searched   groups of rows meet groups of anchors, each of bounded size; a group keeps each window's best while it goes
               through its rows tile by tile, by vec_id; then the groups' best are merged
    mined      first the best rows of the anchor's own label (positives), then of other labels, in each positive's window

Anchors are a stated query set against all rows: the work is anchors times rows, dealt in blocks, and what a block gives
out is bounded by its windows, not by its pairs.

Defined results: rows with a null vec_id or label, a null vector or any null or non-finite component take no part; missing
components of a shorter vector are zeros; of rows that share a vec_id the one of the smallest label, then components,
counts; a component beyond the range for which scores fit a long (2^28 for 64 components, so x of a million) counts as its
end; an empty table gives no rows, and neither does an anchor without positives; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemill.llm.common import forget, in_arrow, stored

SUB = 4
CODES = 256
#: Rows that centroids are fitted on, chosen by a hash of vec_id.
SAMPLE = 4096
ROUNDS = 8
#: Rows and anchors of a group at most, about (a hash deals them).
GROUP_ROWS = 1 << 16
GROUP_ANCHORS = 1 << 13
#: Anchors and rows that are compared at a time: what a tile holds in memory is their product.
TILE_ANCHORS = 256
TILE_ROWS = 4096
#: Candidates that are scored exactly at a time.
PAIRS = 1 << 16

ROWS = "vec_id long, label int, v binary"


def rows(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256) -> tuple[DataFrame, int]:
    """vec_id, label, v (int32 components, as many for each), and how many components."""
    x = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * scale).cast("double"))
    fine = F.forall(F.col(vector), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf")))
    some = embeddings.filter(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()).filter(fine)
    some = some.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("int").alias("label"), x.alias("x"))
    told = some.agg(F.max(F.size("x")).alias("d"), F.count("*").alias("n"), F.count_distinct("vec_id").alias("ids")).first()
    d = max(told["d"] or 0, 1)
    most = float(2 ** min(30, int((62 - math.log2(d)) // 2)))
    if told["n"] > told["ids"]:
        some = some.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("r")).select("vec_id", "r.label", "r.x")

    def run(batches):
        for batch in batches:
            lists = batch.column("x")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            full = np.zeros((len(sizes), d))
            full[np.arange(d)[None, :] < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            whole = np.clip(full, -most, most).astype("<i4")
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), as_binary(whole)], names=["vec_id", "label", "v"])

    return in_arrow(some, run, ROWS), d


def as_binary(matrix: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    flat = np.ascontiguousarray(matrix)
    offsets = np.arange(len(flat) + 1, dtype=np.int32) * (flat.shape[1] * flat.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(offsets), pa.py_buffer(flat.tobytes())])


def as_matrix(column, kind: str, width: int) -> np.ndarray:
    """The rows that as_binary() wrote."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def fitted(vectors: DataFrame, d: int) -> np.ndarray:
    """Centroids (stretch, code, component) by Lloyd's algorithm over the sample; zeros if there are no rows."""
    got = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()
    m = -(-d // SUB)
    full = np.zeros((max(got.num_rows, 1), m * SUB), np.float64)
    if got.num_rows:
        full[:, :d] = as_matrix(got.column("v"), "<i4", d)
    out = np.zeros((m, min(CODES, len(full)), SUB))
    for i in range(m):
        x = full[:, i * SUB : (i + 1) * SUB]
        centres = x[np.linspace(0, len(x) - 1, out.shape[1]).astype(int)].copy()
        for _ in range(ROUNDS):
            code = nearest(x, centres)
            n = np.bincount(code, minlength=len(centres))
            sums = np.stack([np.bincount(code, x[:, j], len(centres)) for j in range(SUB)], 1)
            centres[n > 0] = sums[n > 0] / n[n > 0, None]
        out[i] = centres
    return out


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1)[None, :] - 2 * x @ centres.T).argmin(1)


def indexed(vectors: DataFrame, d: int, centres: np.ndarray) -> DataFrame:
    """vectors with codes (a byte for each stretch) and norms (float32 for each, rounded up) of what the codes leave over."""
    m = len(centres)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1 << 13):
                part = batch.slice(start, 1 << 13)
                x = np.zeros((part.num_rows, m * SUB))
                x[:, :d] = as_matrix(part.column("v"), "<i4", d)
                codes, norms = np.zeros((len(x), m), np.uint8), np.zeros((len(x), m), np.float32)
                for i in range(m):
                    own = x[:, i * SUB : (i + 1) * SUB]
                    codes[:, i] = nearest(own, centres[i])
                    rest = np.sqrt(((own - centres[i][codes[:, i]]) ** 2).sum(1))
                    norms[:, i] = np.nextafter((rest * (1 + 1e-9)).astype(np.float32), np.float32(np.inf))
                yield pa.RecordBatch.from_arrays([*part.columns, as_binary(codes), as_binary(norms)], names=["vec_id", "label", "v", "codes", "norms"])

    return in_arrow(vectors, run, f"{ROWS}, codes binary, norms binary")


class Best:
    """The best of each window so far: exact score and row, higher scores first, ties by smaller vec_id."""

    def __init__(self, windows: int, most: int):
        self.most = most
        self.window, self.score, self.row = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(windows, -np.inf)

    def add(self, window: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        window, score, row = (np.concatenate(pair) for pair in ((self.window, window), (self.score, score), (self.row, row)))
        order = np.lexsort((row, -score, window))
        window, score, row = window[order], score[order], row[order]
        rank = np.arange(len(window)) - np.searchsorted(window, window)
        keep = rank < self.most
        self.window, self.score, self.row = window[keep], score[keep], row[keep]
        last = rank == self.most - 1
        self.floor[window[last]] = score[last]


def group_search(anchors: dict, table: dict, centres: np.ndarray, most: int, same: bool) -> Best:
    """Windows of a group of anchors over a group of rows in order of vec_id.

    anchors: id, label, v, and for each window its anchor (at), low and high score (integers, ends included).
    """
    m, d = len(centres), table["v"].shape[1]
    wide = lambda v: np.pad(v.astype(np.float64), ((0, 0), (0, m * SUB - d)))
    largest = [int(np.abs(x["v"]).max(initial=0)) for x in (anchors, table)]
    small = d * largest[0] * largest[1] < 1 << 53  # then sums of products are exact as doubles too
    window, score, row = [], [], []
    for a0 in range(0, len(anchors["id"]), TILE_ANCHORS):
        mine = slice(a0, a0 + TILE_ANCHORS)
        v, ids, labels = anchors["v"][mine].astype(np.int64), anchors["id"][mine], anchors["label"][mine]
        which = np.flatnonzero((anchors["at"] >= a0) & (anchors["at"] < a0 + TILE_ANCHORS))
        at, lows, highs = anchors["at"][which] - a0, anchors["low"][which], anchors["high"][which]
        first, last = (np.searchsorted(at, np.arange(len(v)), side) for side in ("left", "right"))
        best = Best(len(which), most)
        stretches = wide(v).reshape(len(v), m, SUB)
        lut = np.einsum("ams,mcs->mac", stretches, centres)
        sizes = np.sqrt((stretches**2).sum(2))
        for r0, r1 in tiles(len(table["id"])):
            about = np.zeros((len(v), r1 - r0))
            for i in range(m):
                about += lut[i][:, table["codes"][r0:r1, i]]
            slack = sizes @ table["norms"][r0:r1].T.astype(np.float64)
            slack += 1e-6 * (np.abs(about) + slack) + 1e-3
            # rows come by vec_id: one that only ties with the last one held comes after it
            low, high = np.full(len(v), np.inf), np.full(len(v), -np.inf)
            np.minimum.at(low, at, np.maximum(lows, best.floor + 1))
            np.maximum.at(high, at, highs)
            hit = (about + slack >= low[:, None]) & (about - slack <= high[:, None])
            alike = labels[:, None] == table["label"][None, r0:r1]
            hit &= (alike & (ids[:, None] != table["id"][None, r0:r1])) if same else ~alike
            ai, ri = np.nonzero(hit)
            # where much is left, the whole tile is scored at once
            whole = v.astype(np.float64) @ table["v"][r0:r1].T.astype(np.float64) if small and len(ai) > hit.size // 64 else None
            for p0 in range(0, len(ai), PAIRS):
                a, r = ai[p0 : p0 + PAIRS], ri[p0 : p0 + PAIRS]
                exact = (v[a] * table["v"][r0 + r]).sum(1) if whole is None else whole[a, r].astype(np.int64)
                # each pair meets the windows of its anchor, which lie together in order
                found = []
                for k in range(int((last - first).max(initial=0))):
                    w = first[a] + k
                    some = np.flatnonzero(w < last[a])
                    w, s = w[some], exact[some]
                    inside = (s >= lows[w]) & (s <= highs[w]) & (s > best.floor[w])
                    found.append((w[inside], s[inside], r0 + r[some][inside]))
                if any(len(w) for w, _, _ in found):
                    best.add(*(np.concatenate(c) for c in zip(*found, strict=True)))
        window.append(which[best.window])
        score.append(best.score)
        row.append(best.row)
    out = Best(0, most)
    out.window, out.score, out.row = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (window, score, row))
    return out


def tiles(n: int):
    """Rows of each tile; the first are few, for something to be held against the next."""
    start, size = 0, 256
    while start < n:
        yield start, min(start + size, n)
        start, size = start + size, min(size * 4, TILE_ROWS)


def searched(index: DataFrame, anchors: DataFrame, d: int, centres: np.ndarray, most: int, same: bool, groups: tuple[int, int]) -> DataFrame:
    """anchor_id, window, score, vec_id: the best `most` of each window in each group of rows.

    anchors: vec_id, label, v, windows (array of struct<window, low, high>).
    """
    m, (gx, gy) = len(centres), groups
    deal = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    left = index.withColumns({"gx": deal(gx), "gy": F.explode(F.sequence(F.lit(0), F.lit(gy - 1)))})
    right = anchors.withColumns({"gy": deal(gy), "gx": F.explode(F.sequence(F.lit(0), F.lit(gx - 1)))})
    schema = T._parse_datatype_string("anchor_id long, window long, score long, vec_id long")

    def run(table: pa.Table, asked: pa.Table) -> pa.Table:
        kinds = pa.schema([("anchor_id", pa.int64()), ("window", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64())])
        if not table.num_rows or not asked.num_rows:
            return kinds.empty_table()
        table, asked = table.sort_by("vec_id"), asked.sort_by("vec_id")
        number = lambda t, c: t.column(c).to_numpy().astype(np.int64)
        own = {"id": number(table, "vec_id"), "label": number(table, "label"), "v": as_matrix(table.column("v"), "<i4", d), "codes": as_matrix(table.column("codes"), "u1", m), "norms": as_matrix(table.column("norms"), "<f4", m)}
        windows = asked.column("windows").to_pylist()
        flat = [(i, w["window"], w["low"], w["high"]) for i, some in enumerate(windows) for w in some]
        at, names, low, high = (np.array(c, np.int64) for c in zip(*flat, strict=True)) if flat else (np.zeros(0, np.int64),) * 4
        ask = {"id": number(asked, "vec_id"), "label": number(asked, "label"), "v": as_matrix(asked.column("v"), "<i4", d), "at": at, "low": low, "high": high}
        best = group_search(ask, own, centres, most, same)
        return pa.table([ask["id"][at[best.window]], names[best.window], best.score, own["id"][best.row]], schema=kinds)

    return left.groupBy("gx", "gy").cogroup(right.groupBy("gx", "gy")).applyInArrow(run, schema)


def first(found: DataFrame, most: int, by: list[str]) -> DataFrame:
    """The best `most` rows of each window over all groups, with their rank."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mined(embeddings: DataFrame, relabel=None, anchor=None, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are inner products of floor(scale * x). Anchors are the rows that the column `anchor` says; `relabel` is a column
    of the label to use. A positive's window holds rows of other labels with least * positive_score <= 100 * score <= most * positive_score.
    """
    vectors, d = rows(embeddings, scale=scale)
    vectors = stored(vectors.withColumn("label", F.col("label") if relabel is None else relabel.cast("int")), "negatives-rows")
    centres = fitted(vectors, d)
    index = stored(indexed(vectors, d, centres), "negatives-index")
    forget(vectors)
    asked = stored(index.filter(F.col("vec_id") % 100 == 0 if anchor is None else anchor).select("vec_id", "label", "v"), "negatives-anchors")
    n, n_asked = index.count(), asked.count()
    groups = max(2 * embeddings.sparkSession.sparkContext.defaultParallelism, -(-n // GROUP_ROWS)), max(1, -(-n_asked // GROUP_ANCHORS))
    window = lambda name, low, high: F.struct(name.cast("long").alias("window"), low.cast("long").alias("low"), high.cast("long").alias("high"))
    whole = F.array(window(F.lit(0), F.lit(-(2**62)), F.lit(2**62)))
    near = searched(index, asked.withColumn("windows", whole), d, centres, positives, True, groups)
    near = stored(first(near, positives, ["anchor_id"]).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    # whole numbers from least/100 to most/100 of the score, ends included
    low, high = F.expr(f"ceil(cast(positive_score as decimal(20, 0)) * {least} / 100)"), F.expr(f"floor(cast(positive_score as decimal(20, 0)) * {most} / 100)")
    windows = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(window(F.col("positive_id"), low, high))).alias("windows"))
    found = searched(index, asked.join(windows, "vec_id"), d, centres, negatives, False, groups)
    found = first(found, negatives, ["anchor_id", "window"])
    told = found.select("anchor_id", F.col("window").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(near, ["anchor_id", "positive_id"])
    out = stored(told.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives")
    forget(index, asked, near)
    return out
