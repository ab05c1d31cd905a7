"""Small files and folders on whatever file system a path names, and tables kept in the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _at(spark: SparkSession, path: str):
    told = spark._jvm.org.apache.hadoop.fs.Path(path)
    return told.getFileSystem(spark._jsc.hadoopConfiguration()), told


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _at(spark, path)
    return files.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    files, at = _at(spark, path)
    files.delete(at, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Renames a file or folder to a name that is not taken."""
    files, at = _at(spark, path)
    if not files.rename(at, _at(spark, to)[1]):
        raise OSError(f"{path} could not be renamed to {to}")


def names(spark: SparkSession, folder: str) -> list[str]:
    files, at = _at(spark, folder)
    return sorted(f.getPath().getName() for f in files.listStatus(at)) if files.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """The whole of a small file; None if there is none."""
    files, at = _at(spark, path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written beside its place and then renamed, so that a reader sees the old file or the new one, whole."""
    files, at = _at(spark, path)
    _, beside = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = files.create(beside, True)
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(beside.toUri() if beside.toUri().getScheme() else files.getUri(), spark._jsc.hadoopConfiguration())
    option = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = option
    context.rename(files.makeQualified(beside), files.makeQualified(at), options)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that spark.checkpoint.dir names, which driver and executors share.

    All folders of an application go when it ends. Only in local mode may that setting be absent: then a temporary folder
    is made for it.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidemill-")
        context.setCheckpointDir(base)
    root = f"{base.rstrip('/')}/tables-{context.applicationId}"
    if root not in _ROOTS:
        files, at = _at(spark, root)
        files.mkdirs(at)
        files.deleteOnExit(at)
        _ROOTS.add(root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


_ROOTS: set[str] = set()
#: Tasks for each core that spread() makes, so that none is long and all cores end about together.
TASKS = 3


def kept(df: DataFrame, name: str = "kept") -> DataFrame:
    """df, written once to the shared folder as Parquet and read back: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._kept_at = path
    return out


def spread(rows: DataFrame, *key: str) -> DataFrame:
    """rows over all cores, by a key that few rows share.

    A table of small rows is one file, or a few parts of one, however many rows it has: work on each row that costs more
    than reading it would run in as many tasks. To be called while the rows are still small.
    """
    return rows.repartition(TASKS * rows.sparkSession.sparkContext.defaultParallelism, *key)


def forget(*tables: DataFrame) -> None:
    """Deletes tables that kept() gave and that nothing still to be computed reads."""
    for df in tables:
        delete(df.sparkSession, df._kept_at)
