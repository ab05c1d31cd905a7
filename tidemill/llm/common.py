"""Helpers that the text operators share: tables, folds, shared scratch folders, Arrow batches."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes that a broadcast side of a join may take.
BROADCAST = 32 << 20
#: Bytes of a batch that goes to Python.
BATCH = 4 << 20
#: Code points of a very long text that numpy reads at a time.
PIECE = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """The quarter of the documents that no model may learn from; a null id counts as not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share.

    All folders of one application lie in one, which goes when the application ends. Only in local mode, where driver and
    executors are one process (tests, benchmarks), may the setting be absent: then a temporary folder is made for it.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidemill-")
        context.setCheckpointDir(base)
    root = f"{base.rstrip('/')}/tidemill-{context.applicationId}"
    if root not in _ROOTS:
        files, path = _hadoop(spark, root)
        files.mkdirs(path)
        files.deleteOnExit(path)
        _ROOTS.add(root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


_ROOTS: set[str] = set()


def _hadoop(spark: SparkSession, path: str):
    """The file system that holds a path, and the path, as Hadoop has them."""
    told = spark._jvm.org.apache.hadoop.fs.Path(path)
    return told.getFileSystem(spark._jsc.hadoopConfiguration()), told


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written once to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables that stored() gave and that nothing still to be computed reads."""
    for df in tables:
        files, path = _hadoop(df.sparkSession, df._stored_at)
        files.delete(path, True)


def bounded(df: DataFrame, rows: int, row_bytes: int, most: int = BROADCAST) -> DataFrame:
    """df, to be broadcast if so many rows of about so many bytes (as a hash table holds them) are few; else the join shuffles."""
    return F.broadcast(df) if rows * row_bytes <= most else df


def unused(columns: Iterable[str], name: str) -> str:
    """name, with as many underscores before it as it takes to differ from all columns (in any case of letters)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def in_arrow(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """df.mapInArrow(run, schema), with batches of BATCH bytes at most, unless the session has a setting of its own.

    Both ends of the pipe hold whole batches, so their size counts several times in an executor's memory.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name) == f"{64 << 20}b":
        conf.set(name, str(BATCH))
    return df.mapInArrow(run, schema)


def local(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A few rows from the driver, without the Python workers that createDataFrame takes for a list."""
    kind = to_arrow_schema(T._parse_datatype_string(schema) if isinstance(schema, str) else schema)
    columns = list(zip(*rows, strict=True)) or [()] * len(kind)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind))


def release() -> None:
    """Gives free memory back to the system: Python workers are used again, and the driver's process stays.

    Where the C library has no such call, nothing happens.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, chars: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of the batches with about `chars` bytes of text each (one row at least), and their texts; null is empty.

    Bounds a task's memory by this size and the longest single text, whatever the batch size.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if i > start and total + n > chars:
                part = batch.slice(start, i - start)
                yield part, [x or "" for x in part.column(column).to_pylist()]
                start, total = i, 0
            total += n
        if start < len(sizes):
            part = batch.slice(start)
            yield part, [x or "" for x in part.column(column).to_pylist()]
    release()


def pieces_of(text: str, most: int = PIECE) -> Iterator[str]:
    """A very long text in parts of at most so many code points, cut after a blank or line break.

    Only a run of more than `most` code points without either is cut where it is full, so that no word can take more
    memory than that.
    """
    start = 0
    while len(text) - start > most:
        cut = max(text.rfind(" ", start, start + most), text.rfind("\n", start, start + most), start - 1) + 1
        stop = cut if cut > start else start + most
        yield text[start:stop]
        start = stop
    yield text[start:]
