"""Where intermediate and output files go.

Everything is placed under the folder the cluster names in
``spark.checkpoint.dir``.  Only a local session without that setting (a test)
gets a folder of its own; anywhere else executors could not see such a folder,
so a missing setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"

#: Folders handed out inside each open ``scratch`` block, innermost last.
_open: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if named:
        return named.rstrip("/")
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"{_SETTING} must name a folder that driver and executors share (master is {master})")
    own = tempfile.mkdtemp(prefix="fundtide-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def new_folder(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to."""
    path = f"{shared_folder(spark)}/fundtide/{name}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


def kept_folder(spark: SparkSession, name: str) -> str:
    """As :func:`new_folder`, for a table that outlives an open ``scratch`` block."""
    return f"{shared_folder(spark)}/fundtide/{name}-{uuid.uuid4().hex}"


def version(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of a table's files, which tell whether it has changed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = system.listStatus(folder)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`new_folder` named."""
    if not path.startswith(f"{shared_folder(spark)}/fundtide/"):
        raise ValueError(f"not a work folder: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end of the block every work folder that was handed out in it.

    A job stores its result inside the block; frames that read intermediates are
    of no use after it.
    """
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            remove(spark, path)


def materialized(df: DataFrame, name: str = "stage", partition_by: Sequence[str] = ()) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder once and go on from there.

    Lost executors cannot change rows already written, the rows are computed once,
    and readers know their size.  A filter on ``partition_by`` opens only its folders.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
