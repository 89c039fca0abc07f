"""Per-ticker windows and return curves.

Bars are unique per (ticker, trade_date), so a ticker's window is bounded by the
calendar.  ``row_number <= k`` filters keep their literal form: Spark then drops
surplus rows per task before the shuffle, which also defuses hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundtide.functions.columns import pct_change
from fundtide.functions.dates import day, month
from fundtide.sources.workspace import materialized


def _newest_first(key: str, date: str) -> Window:
    return Window.partitionBy(key).orderBy(F.col(date).desc())


def last_n_rows(bars: DataFrame, n: int, key: str = "ticker", date: str = "trade_date") -> DataFrame:
    """Newest ``n`` rows per key, numbered from 1 (newest) in ``row_num``."""
    numbered = bars.withColumn("row_num", F.row_number().over(_newest_first(key, date)))
    return numbered.filter(F.col("row_num") <= n)


def daily_change(bars: DataFrame, key: str = "ticker", date: str = "trade_date") -> DataFrame:
    """Percent change against the previous bar; 0 for a ticker's first bar."""
    previous = F.lag("close_price").over(Window.partitionBy(key).orderBy(date))
    return bars.withColumn(
        "price_change_percent", F.coalesce(pct_change(F.col("close_price"), previous), F.lit(0.0))
    )


def dual_row_number(bars: DataFrame, key: str = "ticker", date: str = "trade_date") -> DataFrame:
    """Position from the start and from the end of each series; both share one shuffle."""
    oldest_first = Window.partitionBy(key).orderBy(F.col(date).asc())
    return bars.withColumn("rn_start", F.row_number().over(oldest_first)).withColumn(
        "rn_end", F.row_number().over(_newest_first(key, date))
    )


def with_series_length(bars: DataFrame, n: int, key: str = "ticker", date: str = "trade_date") -> DataFrame:
    """Newest ``n`` rows per key with the number of rows the key really has among them."""
    return last_n_rows(bars, n, key, date).withColumn(
        "max_row_num", F.max("row_num").over(Window.partitionBy(key))
    )


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows of every group.  ``order`` must end in a unique key."""
    within = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(within)).filter(F.col(rank) <= k)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], date: str, tie_break: Sequence[Column] = ()
) -> DataFrame:
    """Newest row of every key."""
    return top_k_per_group(df, keys, [F.col(date).desc(), *tie_break], 1, "_newest").drop("_newest")


def month_first_last_value(bars: DataFrame, key: str = "ticker", date: str = "trade_date") -> DataFrame:
    """First and last close of every ticker-month through full-frame window functions."""
    whole = (
        Window.partitionBy(key, "month").orderBy(date)
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return (
        bars.withColumn("month", F.trunc(date, "month"))
        .select(
            key, "month",
            F.first("close_price").over(whole).alias("month_open"),
            F.last("close_price").over(whole).alias("month_close"),
        )
        .distinct()
        .withColumn("monthly_return", pct_change(F.col("month_close"), F.col("month_open")))
    )


def cumulative_return(bars: DataFrame, key: str = "ticker", date: str = "trade_date") -> DataFrame:
    """Percent return since the first close of each series."""
    ordered = Window.partitionBy(key).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = F.first("close_price").over(ordered)
    return bars.withColumn("cum_return", pct_change(F.col("close_price"), base))


def equal_weight_curve(bars: DataFrame, names: DataFrame) -> DataFrame:
    """Compounded mean daily change of the tickers in ``names``.

    A ticker counts from its second bar on; a day it does not trade is a zero
    change.  The day's mean is therefore the sum of the changes present divided
    by the number of tickers that started earlier, so no date x ticker grid is
    built.
    """
    own = Window.partitionBy("ticker").orderBy("trade_date")
    changes = (
        bars.filter(F.col("close_price").isNotNull())
        .join(names.select("ticker"), "ticker", "left_semi")
        .withColumn("previous", F.lag("close_price").over(own))
        .select(
            "trade_date",
            F.try_divide(F.col("close_price") - F.col("previous"), F.col("previous")).alias("change"),
            F.col("previous").isNull().cast("int").alias("starts"),
        )
    )
    by_day = changes.groupBy("trade_date").agg(
        F.sum("change").alias("change_sum"), F.sum("starts").alias("starts")
    ).withColumn("portfolio", F.lit("equal_weight"))
    days = Window.partitionBy("portfolio").orderBy("trade_date")
    live = F.sum("starts").over(days.rowsBetween(Window.unboundedPreceding, -1))
    daily = by_day.withColumn(
        "daily", F.coalesce(F.try_divide(F.col("change_sum"), live), F.lit(0.0))
    )
    to_date = days.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wiped_out = F.min("daily").over(to_date) <= -1
    growth = F.expm1(F.sum(F.log1p(F.when(F.col("daily") > -1, F.col("daily")))).over(to_date))
    return daily.select(
        "trade_date",
        (F.when(wiped_out, F.lit(-1.0)).otherwise(growth) * F.lit(100.0)).alias("cum_return"),
    )


def weighted_portfolio_curve(bars: DataFrame, weights: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Weighted cumulative return of a portfolio beside the benchmark's.

    ``bars`` is already cut to the display window.  The base of every name is its
    close on the window's first date; a name without that close, or without a
    close on a later date, adds 0 there.  Weights are scaled once, over the names
    that have any bar.  With no positive weight the plain mean is used.
    ``weights`` holds one row per portfolio name (ticker, weight).
    """
    weights = materialized(weights.select("ticker", "weight"), "weights")
    # One portfolio's names over the display window; used four times below.
    held = materialized(
        bars.filter(F.col("close_price").isNotNull()).join(weights, "ticker").select(
            "ticker", "trade_date", "close_price", F.coalesce("weight", F.lit(0.0)).alias("weight")
        ),
        "held",
    )
    first_day = held.agg(F.min("trade_date").alias("d")).scalar()
    base = held.filter(F.col("trade_date") == first_day).select(
        "ticker", F.col("close_price").alias("base_price")
    )
    given = weights.agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("w")).scalar()
    live = held.select("ticker", "weight").distinct().agg(F.sum("weight").alias("w")).scalar()

    gain = F.try_divide(F.col("close_price"), F.col("base_price")) - 1
    curve = held.join(base, "ticker", "left").withColumn("gain", gain).groupBy("trade_date").agg(
        F.sum(F.col("gain") * F.col("weight")).alias("weighted"), F.avg("gain").alias("plain")
    )
    weighted = F.coalesce(F.try_divide(F.col("weighted"), live), F.lit(0.0))
    portfolio = curve.select(
        "trade_date",
        (F.when(given > 0, weighted).otherwise(F.col("plain")) * F.lit(100.0)).alias("portfolio_return"),
    )
    reference = cumulative_return(benchmark).select(
        "trade_date", F.col("cum_return").alias("benchmark_return")
    )
    return portfolio.join(reference, "trade_date", "full_outer")


def since(bars: DataFrame, as_of, days: int, date: str = "trade_date") -> DataFrame:
    """Rows of the ``days`` calendar days up to and including ``as_of``.

    A table partitioned by ``trade_month`` is also pruned by it.
    """
    kept = bars.filter((F.col(date) >= day(as_of, days)) & (F.col(date) <= day(as_of)))
    if "trade_month" in bars.columns:
        kept = kept.filter(F.col("trade_month") >= month(as_of, days))
    return kept


def month_to_date(bars: DataFrame, as_of, date: str = "trade_date") -> DataFrame:
    """Rows from the first day of the month of ``as_of`` on; of a stored table only its newest months are opened."""
    kept = bars.filter(F.col(date) >= month(as_of))
    return kept.filter(F.col("trade_month") >= month(as_of)) if "trade_month" in bars.columns else kept
