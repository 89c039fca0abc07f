"""Scans over stored tables and message topics."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundtide.functions.dates import day
from fundtide.schemas import TOPIC


def parquet_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    return (reader.schema(schema) if schema else reader).parquet(path)


def range_predicates(column: str, low: date | None, high: date | None, parts: int) -> list[str]:
    """Conditions that deal the rows of a database table into ``parts`` ranges of days.

    They exclude each other and leave no row out: the first and last range are open, for rows
    that came after ``low`` and ``high`` were looked up, and rows without a date are a range.
    Days are not cut, so there are no more ranges than days.
    """
    if low is None or high is None:
        return ["1 = 1"]
    days = (high - low).days + 1
    parts = max(1, min(parts, days))
    edges = [low + timedelta(days=days * k // parts) for k in range(1, parts)]
    found = []
    for first, last in zip([None, *edges], [*edges, None]):
        ends = [f"{column} >= DATE '{first}'"] if first else []
        ends += [f"{column} < DATE '{last}'"] if last else []
        found.append(" AND ".join(ends) or f"{column} IS NOT NULL")
    return [*found, f"{column} IS NULL"]


def jdbc_table(
    spark: SparkSession, url: str, table: str, partition_column: str, partitions: int, properties: dict[str, str] | None = None,
    since: date | None = None,
) -> DataFrame:
    """The same tables from a database, read in parallel ranges of a date column.

    The ends of the ranges come from one query for the least and greatest date; ``since`` is
    part of that query and of every range, so older rows never leave the database.
    """
    properties = properties or {}
    bound = f"{partition_column} >= DATE '{since}'" if since else "1 = 1"
    probe = f"(SELECT MIN({partition_column}) AS low, MAX({partition_column}) AS high FROM {table} WHERE {bound}) probe"
    low, high = spark.read.jdbc(url, probe, properties=properties).first()
    ranges = [f"({p}) AND {bound}" for p in range_predicates(partition_column, low, high, partitions)]
    return spark.read.jdbc(url, table, predicates=ranges, properties=properties)


def scan_prices(
    prices: DataFrame, since=None, columns: Sequence[str] | None = None, universe: Sequence[str] | None = None
) -> DataFrame:
    """Price bars from a date on, with only the columns asked for."""
    rows = prices
    if since is not None:
        rows = rows.filter(F.col("trade_date") >= day(since))
    if universe is not None:
        rows = rows.filter(F.col("ticker").isin(*universe))
    return rows if columns is None else rows.select(*columns)


def scan_fund_meta(meta: DataFrame, etf_type: str | None = None) -> DataFrame:
    """Fund dimension in ticker order, optionally of one type."""
    rows = meta if etf_type is None else meta.filter(F.col("etf_type") == etf_type)
    return rows.select("ticker", "etf_type", "sector_name").orderBy("ticker")


def scan_recent_holdings(holdings: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Distinct (fund, stock) pairs of the last days."""
    recent = holdings.filter(F.col("as_of_date") >= day(as_of, days))
    return recent.select("etf_ticker", "holding_ticker").distinct()


def scan_allocations(allocations: DataFrame, as_of, periods: Sequence[int]) -> DataFrame:
    """The portfolios of several periods at one date, in one read."""
    return allocations.filter(
        (F.col("as_of_date") == day(as_of)) & F.col("period_days").isin(*periods)
    )


def scan_trending(trending: DataFrame, as_of, meta: DataFrame | None = None) -> DataFrame:
    """Trending funds of a date, best first, with their metadata when given."""
    rows = trending.filter((F.col("as_of_date") == day(as_of)) & F.col("is_trending"))
    rows = rows.select("etf_ticker", "period_days", "return_pct")
    if meta is not None:
        rows = rows.join(meta.withColumnRenamed("ticker", "etf_ticker"), "etf_ticker", "left")
    return rows.orderBy("period_days", F.col("return_pct").desc(), "etf_ticker")


def topic_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None, kafka: dict[str, str] | None = None
) -> DataFrame:
    """Keyed JSON messages as a stream: (key, value) from files, or from Kafka when its connector is present."""
    if kafka is not None:
        raw = spark.readStream.format("kafka").option("startingOffsets", "earliest").options(**kafka).load()
        return raw.select(F.col("key").cast("string"), F.col("value").cast("string"))
    reader = spark.readStream.schema(TOPIC)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def topic_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOPIC).parquet(path)
