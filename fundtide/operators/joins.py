"""Joins between bars, holdings, metadata and results.

All are equi-joins without hints: Spark broadcasts a side only when its size is
known to be below the threshold, and otherwise sort-merge joins with adaptive
skew splitting.  One-row values come in as scalar subqueries, not cross joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundtide import settings
from fundtide.functions.columns import benchmark_order
from fundtide.functions.dates import day
from fundtide.operators.returns import period_returns, point_return
from fundtide.operators.windows import latest_per_key, since, top_k_per_group
from fundtide.sources.workspace import materialized


def prices_with_meta(prices: DataFrame, meta: DataFrame) -> DataFrame:
    """Bars with fund type and sector; funds without metadata stay."""
    return prices.join(meta, "ticker", "left")


def returns_with_holdings(returns: DataFrame, holdings: DataFrame) -> DataFrame:
    """Stock returns next to every fund that holds the stock."""
    pairs = holdings.select("etf_ticker", F.col("holding_ticker").alias("ticker"))
    return returns.join(pairs, "ticker")


def join_latest_metadata(
    stocks: DataFrame, periods: Sequence[int] = settings.PERIODS, require_market_cap: bool = False, **options
) -> DataFrame:
    """Period returns of every stock beside the attributes of its newest row.

    Both come from one numbering of the rows, so the stocks are read once and not joined.
    """
    attributes = ["company_name", "sector", "market_cap"]
    rows = period_returns(stocks, periods, carry=attributes, **options).select("ticker", "period_days", "return_pct", *attributes)
    return rows.filter(F.col("market_cap") > 0) if require_market_cap else rows


def stocks_in_trending_sectors(stock_returns: DataFrame, sector_trends: DataFrame) -> DataFrame:
    """Stocks of the sectors that trend in the same period, with the sector's return."""
    trending = sector_trends.filter("is_trending").select(
        "sector", "period_days", F.col("return_pct").alias("sector_avg")
    )
    return stock_returns.join(trending, ["sector", "period_days"])


def holdings_meta_metrics(holdings: DataFrame, meta: DataFrame, metrics: DataFrame) -> DataFrame:
    """Holdings of known funds with the metrics of the stock held."""
    funds = meta.select(F.col("ticker").alias("etf_ticker"), "etf_type", "sector_name")
    pairs = holdings.select(
        "etf_ticker", "holding_ticker", F.col("holding_name").alias("listed_name"), "holding_percent"
    )
    stocks = metrics.withColumnRenamed("ticker", "holding_ticker")
    return pairs.join(funds, "etf_ticker").join(stocks, "holding_ticker")


def left_join_periods(allocations: DataFrame) -> DataFrame:
    """Names of the 20-day portfolio with their 10- and 5-day weights where present.

    One grouping by (date, ticker) gives what two left joins would.
    """
    def weight(p: int) -> Column:
        return F.max(F.when(F.col("period_days") == p, F.col("portfolio_weight")))

    return (
        allocations.groupBy("as_of_date", "ticker")
        .agg(weight(20).alias("weight_20"), weight(10).alias("weight_10"), weight(5).alias("weight_5"))
        .filter(F.col("weight_20").isNotNull())
    )


def anti_join_new(allocations: DataFrame) -> DataFrame:
    """Rows of the shorter portfolios whose ticker is not in the 20-day one."""
    base = allocations.filter("period_days = 20").select("as_of_date", "ticker")
    return allocations.filter("period_days <> 20").join(base, ["as_of_date", "ticker"], "left_anti")


def within_scalar_range(bars: DataFrame, start: Column, end: Column, reference: Column) -> DataFrame:
    """Rows inside a computed date range, with a computed value attached (NULL when there is none)."""
    return bars.filter(F.col("trade_date").between(start, end)).withColumn("benchmark_return", reference)


def first_last(bars: DataFrame) -> DataFrame:
    """First and last bar of every series side by side, without joining the series to itself."""
    return point_return(bars).select("ticker", "start_date", "start_price", "end_date", "end_price", "return_pct")


def latest_snapshot(holdings: DataFrame) -> DataFrame:
    """All holdings of every fund's newest snapshot.

    The newest date per fund is aggregated first (partial on the map side), so a
    fund holding much of the table is never gathered in one window.  Where positions come
    from trades, ``Book`` picks the snapshot by its totals, without a second read.
    """
    newest = holdings.groupBy("etf_ticker").agg(F.max("as_of_date").alias("as_of_date"))
    return holdings.join(newest, ["etf_ticker", "as_of_date"])


def holdings_left_mcap_returns(holdings: DataFrame, stocks: DataFrame) -> DataFrame:
    """Holdings with market cap and return where known; ``stocks`` is what ``latest_and_return`` gives."""
    known = stocks.select(
        F.col("ticker").alias("holding_ticker"), "company_name", "market_cap", "trade_date",
        F.col("return_pct").alias("holding_return_pct"),
    )
    return holdings.join(known, "holding_ticker", "left").withColumn(
        "holding_name", F.coalesce("holding_name", "company_name")
    )


def holding_across_funds(top_holdings: DataFrame, holding: str | None = None) -> DataFrame:
    """Where a stock ranks in the newest top holdings of all funds; every stock when none is named."""
    newest = top_holdings.groupBy("time_period").agg(F.max("as_of_date").alias("as_of_date"))
    rows = top_holdings.join(newest, ["time_period", "as_of_date"])
    if holding is not None:
        rows = rows.filter(F.col("holding_ticker") == holding.upper())
    return rows.select(
        "holding_ticker", "time_period", "etf_ticker", "etf_type", "sector_name", "rank_position",
        "total_return", "volatility", "as_of_date",
    )


def trending_coverage(
    trending: DataFrame, holdings: DataFrame, stocks: DataFrame, as_of, holding_days: int = 2, stock_days: int = 25
) -> DataFrame:
    """One row: trending funds, distinct stocks they hold, and how many of those have bars.

    Each input is read once: a stock has one row with the newest date on which such a fund
    held it and whether it has bars, and all counts come from these.
    """
    funds = materialized(trending.filter("is_trending").select("etf_ticker").distinct(), "trending")
    held = holdings.join(funds, "etf_ticker", "left_semi").groupBy(F.col("holding_ticker").alias("ticker")).agg(
        F.max("as_of_date").alias("held"))
    priced = since(stocks, as_of, stock_days).select("ticker").distinct().withColumn("priced", F.lit(True))
    known = F.col("ticker").isNotNull()
    return held.join(priced, "ticker", "left").agg(
        F.count_if(known & (F.col("held") >= day(as_of, holding_days))).alias("holdings_count"),
        F.count_if(F.col("priced")).alias("stock_count"),
    ).select(
        funds.agg(F.count("*").alias("n")).scalar().alias("trending_count"), "holdings_count", "stock_count")


def coalesce_two_sources(primary: DataFrame, secondary: DataFrame, key: str = "ticker") -> DataFrame:
    """Sector and name per ticker; the primary source wins where it has a sector.

    Both sources are (ticker, seen, sector, company_name); the newest row of each
    counts.
    """
    def newest(source: DataFrame, tag: str) -> DataFrame:
        return latest_per_key(source, [key], "seen", [F.col("sector"), F.col("company_name")]).filter(
            F.col("sector").isNotNull() & (F.col("sector") != "")
        ).select(
            key, F.col("sector").alias(f"{tag}_sector"),
            F.coalesce("company_name", key).alias(f"{tag}_name"),
        )

    both = newest(primary, "a").join(newest(secondary, "b"), key, "full_outer")
    from_primary = F.col("a_sector").isNotNull()
    return both.select(
        key,
        F.coalesce("a_sector", "b_sector").alias("sector"),
        F.when(from_primary, F.col("a_name")).otherwise(F.col("b_name")).alias("company_name"),
    )


def pick_source_fund(
    picks: DataFrame, benchmark_holdings: DataFrame, priority: Sequence[str] = settings.BENCHMARK_PRIORITY
) -> DataFrame:
    """The benchmark fund to show a pick under, by priority; its own fund when no benchmark holds it.

    ``picks`` is unique per (etf_ticker, holding_ticker).
    """
    offers = benchmark_holdings.select(
        "holding_ticker", F.col("etf_ticker").alias("offered_by")
    ).withColumn("_place", benchmark_order(F.col("offered_by"), priority))
    preferred = top_k_per_group(offers, ["holding_ticker"], [F.col("_place"), F.col("offered_by")], 1, "_n")
    return picks.join(preferred.select("holding_ticker", "offered_by"), "holding_ticker", "left").withColumns({
        "source_etf": F.coalesce("offered_by", "etf_ticker"),
        "source_type": F.when(F.col("offered_by").isNotNull(), "benchmark").otherwise("trending"),
    }).drop("offered_by")
