"""Data-quality gates: one row per rule, ``(rule, observed, required, passed)``.

Each gate reads its tables once and keeps every figure in a partial aggregate;
figures of other tables come in as scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundtide import settings
from fundtide.functions.dates import day
from fundtide.operators.windows import since


def rule(name: str, observed: Column, required: Column | float, passed: Column) -> Column:
    need = required if isinstance(required, Column) else F.lit(required)
    return F.struct(
        F.lit(name).alias("rule"),
        observed.cast("double").alias("observed"),
        need.cast("double").alias("required"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def _at_least(name: str, observed: Column, required: Column | float) -> Column:
    need = required if isinstance(required, Column) else F.lit(required)
    return rule(name, observed, need, observed >= need)


def _rules(figures: DataFrame, *rules: Column) -> DataFrame:
    return figures.select(F.inline(F.array(*rules)))


def gate_price_ready(
    fund_prices: DataFrame, benchmark: str, as_of, min_funds: int = 15, min_rows: int = 15
) -> DataFrame:
    """Enough funds with a bar in the last 2 days, enough benchmark bars in the last 25."""
    recent = F.col("trade_date") >= day(as_of, 2)
    figures = fund_prices.filter(F.col("trade_date") >= day(as_of, 25)).agg(
        F.countDistinct(F.when(recent, F.col("ticker"))).alias("funds"),
        F.count_if(F.col("ticker") == benchmark).alias("benchmark_rows"),
    )
    return _rules(
        figures,
        _at_least("funds_with_recent_bars", F.col("funds"), min_funds),
        _at_least("benchmark_rows", F.col("benchmark_rows"), min_rows),
    )


def gate_allocation_ready(coverage: DataFrame) -> DataFrame:
    """Some fund trends, and holdings and priced stocks are at least as many (see ``trending_coverage``)."""
    funds = F.col("trending_count")
    return _rules(
        coverage,
        rule("trending_funds", funds, 1, funds > 0),
        _at_least("holdings_tracked", F.col("holdings_count"), funds),
        _at_least("stocks_with_history", F.col("stock_count"), funds),
    )


def gate_history_ready(
    meta: DataFrame, stocks: DataFrame, holdings: DataFrame, as_of, days: int = 40, min_days: int = 20
) -> DataFrame:
    """Funds, holdings and at least ``min_days`` trading days of recent stock history exist."""
    recent = since(stocks, as_of, days)
    figures = recent.agg(
        F.countDistinct("ticker").alias("tickers"), F.countDistinct("trade_date").alias("days")
    ).select(
        "tickers", "days",
        meta.agg(F.count("*").alias("n")).scalar().alias("funds"),
        holdings.agg(F.count("*").alias("n")).scalar().alias("positions"),
    )
    return _rules(
        figures,
        rule("stock_tickers", F.col("tickers"), 1, F.col("tickers") > 0),
        _at_least("history_days", F.col("days"), min_days),
        rule("funds", F.col("funds"), 1, F.col("funds") > 0),
        rule("holdings", F.col("positions"), 1, F.col("positions") > 0),
    )


def trending_counts(trending: DataFrame) -> DataFrame:
    """Funds analysed and trending, per date and period."""
    return trending.groupBy("as_of_date", "period_days").agg(
        F.count("*").alias("total_etfs"), F.sum(F.col("is_trending").cast("bigint")).alias("trending_count")
    )


def result_counts(top_holdings: DataFrame, by: str = "time_period") -> DataFrame:
    """Records, funds and newest date per period (or per fund type)."""
    return top_holdings.groupBy(by).agg(
        F.count("*").alias("record_count"),
        F.countDistinct("etf_ticker").alias("etf_count"),
        F.max("as_of_date").alias("latest_date"),
    )


def missing_periods(top_holdings: DataFrame, expected: Sequence[int] = settings.PERIODS) -> DataFrame:
    """Expected periods without any result."""
    spark = top_holdings.sparkSession
    wanted = spark.range(1).select(F.explode(F.array(*[F.lit(p) for p in expected])).alias("time_period"))
    return wanted.join(top_holdings.select("time_period").distinct(), "time_period", "left_anti")


def collected_counts(
    trending: DataFrame, holdings: DataFrame, stocks: DataFrame, as_of, holdings_date: Column
) -> DataFrame:
    """Funds and stocks collected on the newest snapshot against the number of trending funds."""
    snapshot = holdings.filter(F.col("as_of_date") == holdings_date)
    recent = stocks.filter(F.col("trade_date") >= day(as_of, 1))
    return snapshot.agg(
        F.countDistinct("etf_ticker").alias("etf_count"),
        F.countDistinct("holding_ticker").alias("holding_count"),
    ).select(
        "etf_count", "holding_count",
        recent.agg(F.countDistinct("ticker").alias("n")).scalar().alias("stock_count"),
        trending.agg(F.count_if("is_trending").alias("n")).scalar().alias("trending_count"),
    )


def verify_weights(
    portfolio: DataFrame, group: Sequence[str], weight: str, max_rows: int | None = None, tolerance: float = 0.01
) -> DataFrame:
    """Per portfolio: rows, total weight, and whether both are as they should be."""
    checked = portfolio.groupBy(*group).agg(
        F.count("*").alias("stock_count"), F.sum(weight).alias("total_weight")
    ).withColumn("weight_ok", F.abs(F.col("total_weight") - 1.0) <= tolerance)
    small = F.lit(True) if max_rows is None else F.col("stock_count") <= max_rows
    return checked.withColumn("size_ok", small)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def bounds_checks(
    bars: DataFrame, timestamps: DataFrame | None = None, change: str = "price_change_percent"
) -> DataFrame:
    """Violations of the value bounds of bars, and of unreadable timestamps.

    ``timestamps`` is (raw_timestamp); a row whose text cannot be read counts.
    """
    price, volume = F.col("close_price"), F.col("volume")
    bad_return = (F.col(change) <= -100) | (F.col(change) >= 500)
    bad_price = (price <= 0) | (price >= 1000000)
    figures = bars.agg(
        F.count_if(bad_return).alias("returns"),
        F.count_if(volume <= 0).alias("volumes"),
        F.count_if(bad_price).alias("prices"),
    )
    checks = [
        rule("return_within_bounds", F.col("returns"), 0, F.col("returns") == 0),
        rule("volume_positive", F.col("volumes"), 0, F.col("volumes") == 0),
        rule("price_within_bounds", F.col("prices"), 0, F.col("prices") == 0),
    ]
    if timestamps is not None:
        unreadable = F.col("raw_timestamp").isNotNull() & F.try_to_timestamp("raw_timestamp").isNull()
        figures = figures.withColumn(
            "stamps", timestamps.agg(F.count_if(unreadable).alias("n")).scalar()
        )
        checks.append(rule("timestamp_readable", F.col("stamps"), 0, F.col("stamps") == 0))
    return _rules(figures, *checks)


def inventory(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Rows and date range per key."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("row_count"), F.min(date).alias("min_date"), F.max(date).alias("max_date")
    )


def collection_success(
    expected: DataFrame, received: DataFrame, key: str = "ticker",
    max_failed: float = 0.7, min_success: float = 0.5,
) -> DataFrame:
    """Share of the expected universe received, with both failure rules."""
    arrived = received.select(key).distinct().withColumn("_arrived", F.lit(1))
    totals = expected.select(key).distinct().join(arrived, key, "left").agg(
        F.count("*").alias("expected_count"),
        F.count("_arrived").alias("success_count"),
    )
    share = F.try_divide(F.col("success_count").cast("double"), F.col("expected_count"))
    return totals.select(
        "expected_count", "success_count",
        (F.col("expected_count") - F.col("success_count")).alias("failed_count"),
        (share * 100.0).alias("success_rate"),
        F.coalesce(1.0 - share > max_failed, F.lit(True)).alias("too_many_failures"),
        F.coalesce(share < min_success, F.lit(True)).alias("below_success_floor"),
    )
