"""Writes: append, replace a slice, keyed upsert, and message topics.

Tables are Parquet folders partitioned by a date-like column.  A rewrite touches
only the partitions of the incoming rows (dynamic partition overwrite).  What is
read from the table being rewritten is merged into the shared folder first,
so no task ever reads a file the same job replaces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundtide.operators.sets import upsert_by_key
from fundtide.sources import workspace

#: Partitions that one upsert may touch; a partition is a calendar period, so more is an error.
MOST_PARTITIONS = 5000


def messages(df: DataFrame, key: str) -> DataFrame:
    """Rows as keyed JSON messages."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def write_topic(rows: DataFrame, path: str, kafka: dict[str, str] | None = None) -> None:
    """Append (key, value) messages to a topic: files, or Kafka when its connector is present."""
    if kafka is not None:
        rows.write.format("kafka").options(**kafka).save()
    else:
        rows.write.mode("append").parquet(path)


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_slices(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions present in ``df``; running it twice changes nothing."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by).parquet(path)
    )


def read_or_none(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The table, or None when nothing has been written yet."""
    try:
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def only_partitions(table: DataFrame, partition: str, values: Sequence) -> DataFrame:
    """The rows of the named partitions, by literals, so that no other file is opened; None names the NULL one."""
    column = F.col(partition)
    wanted = column.isin(*[v for v in values if v is not None])
    return table.filter(wanted | column.isNull() if None in values else wanted)


def upsert_rows(
    incoming: DataFrame, path: str, keys: Sequence[str], partition: str, order: Sequence[Column] = ()
) -> None:
    """Insert or update ``incoming`` by key.  ``partition`` must be a function of the keys.

    The partitions that the incoming rows touch are looked up first and name the part of
    the table to read, so no other file is opened.  NULL is a partition like any other.
    """
    spark = incoming.sparkSession
    with workspace.scratch(spark):
        # Read three times: kept in the shared folder, so lost executors cannot change it.
        incoming = workspace.materialized(incoming, "incoming")
        touched = [r[0] for r in incoming.select(partition).distinct().limit(MOST_PARTITIONS + 1).collect()]
        if len(touched) > MOST_PARTITIONS:
            raise ValueError(f"an upsert touches more than {MOST_PARTITIONS} values of {partition}")
        if not touched:
            return
        # With the schema given, the partition column keeps its type.
        existing = read_or_none(spark, path, incoming.schema)
        if existing is None:
            existing = incoming.limit(0)
        else:
            existing = only_partitions(existing, partition, touched)
        merged = workspace.materialized(
            upsert_by_key(existing.select(*incoming.columns), incoming, keys, order), "merged"
        )
        replace_slices(merged, path, [partition])
