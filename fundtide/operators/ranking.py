"""Ranks over groups of any size, and global top-k.

A full ranking cannot go through ``Window.partitionBy(group)``: with three
periods, one group is a third of the table.  :func:`global_rank` range-sorts the
rows instead, so no task ever holds more than one range.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundtide.operators.windows import top_k_per_group
from fundtide.sources.workspace import materialized

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition number above this bit


def global_rank(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], rank: str = "rank"
) -> DataFrame:
    """Exact ranks 1..n inside every group.

    The rows are range-partitioned and sorted by (group, order) and written to the
    shared folder, which fixes their positions.  A rank is then the position inside
    the range plus the rows of the same group in earlier ranges - a table with one
    row per range and group, which is all that is ever windowed.  A NULL group is a
    group.
    """
    placed = materialized(
        df.orderBy(*[F.col(g) for g in group], *order)
        .withColumn("_position", F.monotonically_increasing_id())
    ).withColumn("_range", F.shiftright("_position", _ROW_BITS))

    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy(*group, "_range").agg(
        F.count("*").alias("_rows"), F.min("_position").alias("_first")
    ).withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")

    place = F.col("p._position") - F.col("r._first") + F.col("r._before") + 1
    keys = [*group, "_range"]
    same = reduce(and_, [F.col(f"p.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    counted = placed.alias("p").join(ranges.alias("r"), same)
    return counted.select(*[F.col(f"p.{c}") for c in df.columns], place.cast("int").alias(rank))


def top_by_weight(holdings: DataFrame, k: int, group: str = "etf_ticker", arrival: str | None = None) -> DataFrame:
    """Top ``k`` holdings per fund by percent; equal ones in the order of ``arrival``, then by ticker.

    A holding without percent is left out, unless no holding of the fund has one: then the
    order of arrival alone counts.  The input is read once: holdings with and without percent
    are cut to ``k`` each, and which of the two counts is told from those few.
    """
    named = holdings.filter(F.col("holding_ticker").isNotNull() & (F.col("holding_ticker") != ""))
    order = [F.col("holding_percent").desc_nulls_last(), *([F.col(arrival)] if arrival else []), F.col("holding_ticker")]
    told = named.withColumn("_told", F.col("holding_percent").isNotNull())
    few = top_k_per_group(told, [group, "_told"], order, k)
    # At most 2k rows of a fund are left.
    known = F.max("_told").over(Window.partitionBy(group))
    return few.withColumn("_known", known).filter(F.col("_told") == F.col("_known")).drop("_told", "_known")


def market_cap_rank(
    holdings: DataFrame, k: int, group: str = "etf_ticker", name: str = "holding_ticker", rank: str = "mcap_rank"
) -> DataFrame:
    """Top ``k`` holdings per fund by market cap, unknown caps last."""
    return top_k_per_group(
        holdings, [group], [F.col("market_cap").desc_nulls_last(), F.col(name)], k, rank
    )


def top_holdings_by_market_cap(holdings: DataFrame, k: int = 5, group: str = "etf_ticker") -> DataFrame:
    """As :func:`market_cap_rank`, with holdings of no market cap left out."""
    return market_cap_rank(holdings.filter(F.col("market_cap") > 0), k, group)


def limit_groups(df: DataFrame, group: str, n: int) -> DataFrame:
    """All rows of the first ``n`` groups in key order."""
    first = df.select(group).distinct().orderBy(group).limit(n)
    return df.join(first, group, "left_semi")
