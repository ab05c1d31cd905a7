"""Media columns: content-addressed payloads in tar shards; rows carry digest, offset and length.

Bytes are stored losslessly as 8-bit gray PNG images, 192 samples a row. Each task writes tar shards of its own into a
shared folder; a member's name is the digest of its payload, and a payload that a shard already holds is not written
again. The index (a Parquet table) is all that later steps shuffle or filter: header-only range reads (33 bytes at a
member's offset) fill metadata columns, and whole range reads give payloads back where a feature needs them.

A shard's name is new for each attempt of a task, and rows name the shard that their own attempt wrote; so a task that
runs again after a lost executor leaves at most an unused shard behind. Paths go through pyarrow's file systems, which
must know the scheme of the shared folder.

Defined results: a null text counts as empty, and an empty one is stored as 192 blanks. Equal texts have equal values
in all columns but shard and offset. Rows that repeat stay as they are; an empty table gives an empty index.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import in_arrow, slices

WIDTH = 192
HEADER = 33
SHARD_BYTES = 256 << 20
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def padded(data: bytes) -> bytes:
    """With blanks up to a positive multiple of WIDTH."""
    return data + b" " * (max(WIDTH, -(-len(data) // WIDTH) * WIDTH) - len(data))


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes, level: int = 1) -> bytes:
    samples = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(samples), WIDTH + 1), np.uint8)
    lines[:, 1:] = samples
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, len(samples), 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + chunk(b"IEND", b"")


def png_header(head: bytes) -> tuple[int, int, int]:
    """Width, height and bit depth, from the first HEADER bytes."""
    if head[:8] != SIGNATURE or head[12:16] != b"IHDR" or len(head) < HEADER:
        raise ValueError("no PNG header here")
    return struct.unpack(">IIB", head[16:25])


def from_png(data: bytes) -> bytes:
    """The samples of an image that to_png() wrote."""
    width, height, _ = png_header(data)
    at, packed = 8, []
    while at < len(data):
        (n,) = struct.unpack(">I", data[at : at + 4])
        if data[at + 4 : at + 8] == b"IDAT":
            packed.append(data[at + 8 : at + 8 + n])
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("only images without filters are read")
    return lines[:, 1:].tobytes()


class Shard:
    """A tar file that grows by one member for each new digest."""

    def __init__(self, root: str):
        self.files, folder = fs.FileSystem.from_uri(root)
        self.files.create_dir(folder, recursive=True)
        self.path = f"{folder}/shard-{uuid.uuid4().hex}.tar"
        self.out, self.at = self.files.open_output_stream(self.path), 0
        self.held: dict[bytes, tuple[int, int, str]] = {}

    def put(self, digest: bytes, payload: bytes) -> tuple[int, int, str]:
        """Offset and length of the stored form, and its SHA-256."""
        if digest not in self.held:
            data = to_png(payload)
            member = tarfile.TarInfo(f"{digest.hex()}.png")
            member.size = len(data)
            head = member.tobuf(tarfile.USTAR_FORMAT)
            self.held[digest] = self.at + len(head), len(data), hashlib.sha256(data).hexdigest()
            block = head + data + b"\0" * (-len(data) % tarfile.BLOCKSIZE)
            self.out.write(block)
            self.at += len(block)
        return self.held[digest]

    def close(self) -> None:
        self.out.write(b"\0" * 2 * tarfile.BLOCKSIZE)
        self.out.close()


INDEX = T.StructType(
    [
        T.StructField(name, kind())
        for name, kind in (("n_bytes", T.LongType), ("payload_bytes", T.LongType), ("digest", T.StringType), ("shard", T.StringType), ("offset", T.LongType), ("media_bytes", T.LongType), ("media_sha256", T.StringType))
    ]
)


def store(documents: DataFrame, root: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id and the INDEX columns. Lazy: write the result once and read that (see media_index)."""
    schema = T.StructType([documents.schema["doc_id"], *INDEX.fields])

    def run(batches):
        shard = None
        for part, texts in slices(batches, "text"):
            rows = []
            for text in texts:
                data = text.encode("utf-8", "replace")
                payload = padded(data)
                digest = hashlib.sha256(payload).digest()
                if shard is None or shard.at > shard_bytes:
                    if shard is not None:
                        shard.close()
                    shard = Shard(root)
                offset, size, own = shard.put(digest, payload)
                rows.append((len(data), len(payload), digest.hex(), shard.path, offset, size, own))
            columns = zip(*rows, strict=True)
            arrays = [pa.array(c, pa.int64() if f.dataType == T.LongType() else pa.string()) for c, f in zip(columns, INDEX.fields, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], names=schema.names)
        if shard is not None:
            shard.close()

    return in_arrow(documents.select("doc_id", F.col("text").cast("string").alias("text")), run, schema)


def media_index(documents: DataFrame, root: str) -> DataFrame:
    """The index of all payloads, stored under root beside the shards: shards are written by this call alone."""
    index = store(documents, f"{root}/shards")
    index.write.parquet(f"{root}/index")
    return documents.sparkSession.read.schema(index.schema).parquet(f"{root}/index")


#: Stored bytes that one task reads back.
TASK_BYTES = 16 << 20


def dealt(index: DataFrame) -> DataFrame:
    """index in partitions of about TASK_BYTES of stored bytes, each from few stretches of few shards: rows are small, what they point to is not."""
    total = index.agg(F.coalesce(F.sum("media_bytes"), F.lit(0)).alias("n")).first()["n"]
    stretch = F.floor(F.col("offset") / F.lit(TASK_BYTES // 4))
    return index.repartition(max(1, -(-total // TASK_BYTES)), "shard", stretch).sortWithinPartitions("shard", "offset")


def ranges(batches, root: str, size):
    """Batches with the bytes of each row, read from its shard; size gives how many for a row's media_bytes."""
    files, _ = fs.FileSystem.from_uri(root)
    path, opened = None, None
    for batch in batches:
        got = []
        for shard, offset, length in zip(*(batch.column(c).to_pylist() for c in ("shard", "offset", "media_bytes")), strict=True):
            if shard != path:
                path, opened = shard, files.open_input_file(shard)
            got.append(opened.read_at(size(length), offset))
        yield batch, got


def with_metadata(index: DataFrame, root: str) -> DataFrame:
    """index with width, height and bits, from header-only range reads."""
    names = ("width", "height", "bits")
    kept = [f for f in index.schema.fields if f.name not in names]
    schema = T.StructType([*kept, *(T.StructField(n, T.IntegerType()) for n in names)])

    def run(batches):
        for batch, heads in ranges(batches, root, lambda length: min(HEADER, length)):
            found = [png_header(h) for h in heads]
            arrays = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*arrays, *(pa.array([x[k] for x in found], pa.int32()) for k in range(3))], names=schema.names)

    return in_arrow(index.select(*(f.name for f in kept)), run, schema)


def feature(payload: bytes) -> str:
    """Mean, deviation and entropy (bits) of the samples, and the share of each sixteenth of their range in thousandths."""
    n = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    p = n / n.sum()
    mean = float(p @ np.arange(256))
    spread = float(np.sqrt(max(p @ (np.arange(256) - mean) ** 2, 0)))
    full = p[p > 0]
    return f"{mean:.3f};{spread:.3f};{float(-(full @ np.log2(full))) + 0.0:.4f};" + ",".join(str(int(x)) for x in n.reshape(16, 16).sum(axis=1) * 1000 // n.sum())


def with_features(index: DataFrame, root: str) -> DataFrame:
    """index with payload_sha256, tail_crc32 and feature, from the stored bytes read back whole."""
    new = (("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("feature", T.StringType()))
    kept = [f for f in index.schema.fields if f.name not in {n for n, _ in new}]
    schema = T.StructType([*kept, *(T.StructField(n, k) for n, k in new)])

    def run(batches):
        # few rows at a time: a range read holds them all
        small = (b.slice(i, 64) for b in batches for i in range(0, b.num_rows, 64))
        for batch, stored in ranges(small, root, lambda length: length):
            found = [(hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]), feature(p)) for p in map(from_png, stored)]
            arrays = [batch.column(f.name) for f in kept]
            more = [pa.array([x[k] for x in found], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*arrays, *more], names=schema.names)

    return in_arrow(index.select(*(f.name for f in kept)), run, schema)
