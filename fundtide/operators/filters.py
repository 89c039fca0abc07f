"""Row filters and row-level projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtide import settings
from fundtide.functions import columns as C
from fundtide.functions.dates import day
from fundtide.operators.windows import since, top_k_per_group


def trailing_days(bars: DataFrame, as_of, days: int, ticker: str | None = None, date: str = "trade_date") -> DataFrame:
    """Rows of the last ``days`` calendar days, optionally of one ticker."""
    kept = since(bars, as_of, days, date)
    return kept.filter(F.col("ticker") == ticker.upper()) if ticker else kept


def price_history(
    bars: DataFrame, start=None, end=None, symbol: str | None = None, limit: int | None = None
) -> DataFrame:
    """History view: inclusive date range, newest ``limit`` rows per symbol."""
    rows = bars
    if symbol is not None:
        rows = rows.filter(F.col("ticker") == symbol.upper())
    if start is not None:
        rows = rows.filter(F.col("trade_date") >= day(start))
    if end is not None:
        rows = rows.filter(F.col("trade_date") <= day(end))
    if limit is not None:
        rows = top_k_per_group(rows, ["ticker"], [F.col("trade_date").desc()], limit, "_n").drop("_n")
    return rows.select(
        F.col("ticker").alias("symbol"), "sector",
        F.col("close_price").alias("avg_price"), F.col("volume").alias("total_volume"),
        F.col("low_price").alias("min_price"), F.col("high_price").alias("max_price"),
        F.lit(1).alias("record_count"),
        F.col("trade_date").alias("window_start"), F.col("trade_date").alias("window_end"),
    )


def valid_instruments(
    df: DataFrame,
    ticker: str = "ticker",
    name: str | None = None,
    pattern: str = settings.PLACEHOLDER_TICKER,
    prefixes: Sequence[str] = settings.PLACEHOLDER_NAME_PREFIXES,
) -> DataFrame:
    """Drop placeholder tickers and names; rows without a name go too when names are checked."""
    return df.filter(
        C.is_real_instrument(F.col(ticker), F.col(name) if name else None, pattern, prefixes)
    )


def known_sector(df: DataFrame) -> DataFrame:
    return df.filter(C.has_known_sector(F.col("sector")))


def min_coverage(returns: DataFrame, coverage: float = settings.MIN_COVERAGE) -> DataFrame:
    """Keep series holding at least ``coverage`` of their period's rows."""
    return returns.filter(F.col("day_count") >= F.col("period_days") * F.lit(coverage))


def in_set(df: DataFrame, members: DataFrame, key: str, member_key: str | None = None) -> DataFrame:
    """Rows whose key occurs in ``members``."""
    wanted = members.select(F.col(member_key or key).alias(key)).distinct()
    return df.join(wanted, key, "left_semi")


def allowed_universe(df: DataFrame, tickers: Sequence[str] = settings.TREND_UNIVERSE) -> DataFrame:
    return df.filter(F.col("ticker").isin(*tickers))


def non_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def with_sector(df: DataFrame, mapping: Mapping[str, str] = settings.SECTOR_OF_FUND) -> DataFrame:
    """Sector of a fund from a literal map."""
    return df.withColumn("sector", C.lookup(F.col("ticker"), mapping))


def classify_funds(
    returns: DataFrame,
    meta: DataFrame,
    benchmark_return,
    benchmark: str = settings.MAIN_BENCHMARK,
    benchmark_funds: Sequence[str] = settings.BENCHMARK_FUNDS,
) -> DataFrame:
    """Flags, category and display name of every fund with a return."""
    trending = (F.col("ticker") != benchmark) & C.is_trending(
        F.col("return_pct"), F.coalesce(benchmark_return, F.lit(0.0))
    )
    return returns.join(meta, "ticker", "left").select(
        *returns.columns,
        F.col("ticker").isin(*benchmark_funds).alias("is_benchmark"),
        trending.alias("is_trending"),
        F.when(F.col("sector_name").isNotNull(), "sector").otherwise("benchmark").alias("category"),
        F.coalesce("sector_name", "ticker").alias("name"),
    )


def with_defaults(stocks: DataFrame) -> DataFrame:
    """Missing company -> ticker, sector -> 'Unknown', market cap -> 0."""
    return stocks.withColumns({
        "company_name": F.coalesce("company_name", "ticker"),
        "sector": F.coalesce("sector", F.lit(settings.UNKNOWN_SECTOR)),
        "market_cap": F.coalesce("market_cap", F.lit(0).cast("bigint")),
    })
