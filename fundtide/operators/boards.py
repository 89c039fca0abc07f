"""Sector, fund and stock boards."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtide import settings
from fundtide.functions.columns import is_trending
from fundtide.functions.dates import day
from fundtide.operators.ranking import global_rank
from fundtide.operators.returns import calendar_returns, point_return
from fundtide.operators.windows import latest_per_key, month_to_date, since, top_k_per_group
from fundtide.sources.workspace import materialized

#: Names that one row may list, and columns that a matrix may have.
MOST_NAMES, MOST_COLUMNS = 100_000, 1000


def sector_summary(stocks: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Average change, counts and volume per sector over the last days."""
    recent = since(stocks, as_of, days).filter(F.col("sector").isNotNull())
    return (
        recent.groupBy("sector")
        .agg(
            F.avg("price_change_percent").alias("avg_change_pct"),
            F.count("*").alias("row_count"),
            F.countDistinct("ticker").alias("stock_count"),
            F.sum("volume").alias("total_volume"),
            F.max("trade_date").alias("latest_date"),
        )
        .withColumn("is_trending", F.coalesce(F.col("avg_change_pct") > 0, F.lit(False)))
    )


def sector_point_in_time(meta: DataFrame, fund_prices: DataFrame, stocks: DataFrame) -> DataFrame:
    """Newest change of every sector fund with the size of its sector."""
    funds = meta.filter((F.col("etf_type") == "sector") & F.col("sector_name").isNotNull())
    newest = latest_per_key(
        fund_prices.select("ticker", "trade_date", "price_change_percent").join(funds, "ticker"),
        ["ticker"], "trade_date",
    )
    counts = stocks.groupBy(F.col("sector").alias("sector_name")).agg(
        F.count("*").alias("row_count"), F.countDistinct("ticker").alias("stock_count")
    )
    zero = F.lit(0).cast("bigint")
    return newest.join(counts, "sector_name", "left").select(
        F.col("sector_name").alias("sector"), "ticker",
        F.col("price_change_percent").alias("avg_change_percent"),
        F.coalesce("row_count", zero).alias("row_count"),
        F.coalesce("stock_count", zero).alias("stock_count"),
        (F.col("price_change_percent") > 0).alias("is_trending"),
    )


def sector_change_sums(
    stocks: DataFrame, fund_prices: DataFrame, benchmark: str, as_of, days: int, k: int = 10
) -> DataFrame:
    """Sectors by summed daily change over ``days`` + 3 days, beside the benchmark's sum."""
    window = days + 3
    reference = (
        since(fund_prices, as_of, window).filter(F.col("ticker") == benchmark)
        .agg(F.coalesce(F.sum("price_change_percent"), F.lit(0.0)).alias("s")).scalar()
    )
    return (
        since(stocks, as_of, window).groupBy("sector")
        .agg(F.sum("price_change_percent").alias("cum_return"))
        .orderBy(F.col("cum_return").desc(), "sector").limit(k)
        .withColumn("benchmark_cum_return", reference)
    )


def _market_rows(stocks: DataFrame) -> DataFrame:
    return stocks.filter(
        (F.col("ticker") != settings.MAIN_BENCHMARK) & (F.col("sector") != settings.BENCHMARK_SECTOR)
    )


def mtd_top_equal_weight(stocks: DataFrame, as_of, k: int = 10) -> DataFrame:
    """Top tickers by average daily change this month; over the whole history when the month is empty."""
    rows = _market_rows(stocks)

    def averages(part: DataFrame) -> DataFrame:
        return part.groupBy("ticker", "company_name", "sector").agg(F.avg("price_change_percent").alias("avg_change"))

    # One row per ticker, written once: whether there is any decides if the history is read at all.
    found = materialized(averages(month_to_date(rows, as_of)), "month-averages")
    if found.isEmpty():
        found = averages(rows)
    return found.orderBy(F.col("avg_change").desc(), "ticker").limit(k)


def sector_leaders(stocks: DataFrame, as_of, k: int = 10, only_month: bool = True) -> DataFrame:
    """Best stock by average change in each rising sector.

    Sectors with a positive average, best ``k`` first; the best ``k`` of all when
    none is positive.
    """
    end = day(as_of)
    rows = _market_rows(stocks)
    if only_month:
        rows = month_to_date(rows, as_of)
    # The rows are read once; sector averages come from the per-ticker sums.
    tickers = materialized(
        rows.groupBy("ticker", "company_name", "sector").agg(
            F.avg("price_change_percent").alias("avg_monthly_return"),
            F.sum("price_change_percent").alias("change_sum"),
            F.count("price_change_percent").alias("changes"),
        ),
        "ticker-averages",
    )
    sectors = tickers.groupBy("sector").agg(
        F.try_divide(F.sum("change_sum"), F.sum("changes")).alias("sector_avg")
    )
    none_rises = sectors.agg((F.count_if(F.col("sector_avg") > 0) == 0).alias("n")).scalar()
    chosen = (
        sectors.filter((F.col("sector_avg") > 0) | none_rises)
        .orderBy(F.col("sector_avg").desc(), "sector").limit(k)
    )
    best = top_k_per_group(
        tickers.join(chosen.select("sector"), "sector", "left_semi"),
        ["sector"], [F.col("avg_monthly_return").desc(), F.col("ticker")], 1, "_n",
    )
    return best.select(
        F.year(end).alias("year"), F.month(end).alias("month"),
        "ticker", "company_name", "sector", "avg_monthly_return", F.lit(True).alias("is_trending"),
    )


class TrendBoard(NamedTuple):
    sectors: DataFrame
    leaders: DataFrame
    details: DataFrame


def period_trend_board(
    stocks: DataFrame,
    fund_prices: DataFrame,
    fund_sectors: DataFrame,
    benchmark: str,
    as_of,
    periods: Sequence[int] = settings.PERIODS,
    sector_limit: int = 10,
    detail_sectors: int = 5,
    detail_stocks: int = 5,
) -> TrendBoard:
    """Trending sectors of each calendar window, their best stock, and their best five.

    A window reaches ``N + 3`` days back.  A sector's return is its fund's (0 with
    fewer than two bars), else the mean of its stocks.  ``fund_sectors`` is
    (ticker, sector), one fund per sector.
    """
    keys = ("ticker", "period_days")
    # One row per fund and period, read for the benchmark and for the sectors.
    fund_gain = materialized(calendar_returns(fund_prices, as_of, periods, 3).withColumn(
        "gain", F.when(F.col("day_count") >= 2, F.col("return_pct")).otherwise(F.lit(0.0))
    ).select(*keys, "gain"), "fund-gains")
    # One row per period.
    reference = F.broadcast(
        fund_gain.filter(F.col("ticker") == benchmark).select("period_days", F.col("gain").alias("benchmark_return"))
    )
    sector_gain = fund_sectors.join(fund_gain, "ticker", "left").select(
        "sector", "period_days", "gain"
    ).filter(F.col("period_days").isNotNull())

    # One row per stock and period, read for the sectors, the leaders and the details.
    gains = materialized(
        calendar_returns(stocks, as_of, periods, 3, ("ticker", "company_name", "sector"))
        .filter((F.col("day_count") >= 2) & (F.col("end_price") > 0))
        .withColumnRenamed("return_pct", "period_return")
        .select(*keys, "company_name", "sector", "period_return", "start_price", "end_price"),
        "stock-gains",
    )
    by_sector = (
        gains.groupBy("sector", "period_days")
        .agg(F.count("*").alias("stock_count"), F.avg("period_return").alias("stock_mean"))
        .join(sector_gain, ["sector", "period_days"], "left")
        .join(reference, "period_days", "left")
        .withColumn("avg_return", F.coalesce("gain", "stock_mean"))
    )
    trending = by_sector.filter(
        is_trending(F.col("avg_return"), F.coalesce("benchmark_return", F.lit(0.0)))
    )
    # A few rows per period, for all three results.
    sectors = materialized(top_k_per_group(
        trending, ["period_days"], [F.col("avg_return").desc(), F.col("sector")], sector_limit, "sector_rank"
    ).select("period_days", "sector_rank", "sector", "stock_count", "avg_return"), "sectors")

    placed = gains.join(sectors.select("period_days", "sector", "sector_rank"), ["period_days", "sector"])
    order = [F.col("period_return").desc(), F.col("ticker")]
    group = ["period_days", "sector"]
    leaders = top_k_per_group(placed, group, order, 1, "stock_rank")
    details = top_k_per_group(
        placed.filter(F.col("sector_rank") <= detail_sectors), group, order, detail_stocks, "stock_rank"
    )
    return TrendBoard(sectors, leaders, details)


def funds_by_type(meta: DataFrame) -> DataFrame:
    """Number and names of the funds of each type.

    A type of more than MOST_NAMES funds is an error; no more names than that ever meet in a row.
    """
    counts = meta.groupBy("etf_type").agg(F.count("*").alias("fund_count"))
    some = top_k_per_group(meta, ["etf_type"], [F.col("ticker")], MOST_NAMES, "_n")
    names = some.groupBy(F.col("etf_type").alias("_type")).agg(
        F.array_join(F.sort_array(F.collect_list("ticker")), ", ").alias("_names"))
    too_many = F.concat(F.lit("too many funds of type "), "etf_type")
    return counts.join(names, F.col("etf_type").eqNullSafe(F.col("_type"))).select(
        "etf_type", "fund_count",
        F.when(F.col("fund_count") > MOST_NAMES, F.raise_error(too_many).cast("string")).otherwise(F.col("_names"))
        .alias("tickers"),
    )


def column_tickers(meta: DataFrame) -> list[str]:
    """The tickers of a dimension table as columns of a matrix; more than MOST_COLUMNS are an error."""
    found = [r[0] for r in meta.select("ticker").distinct().orderBy("ticker").limit(MOST_COLUMNS + 1).collect()]
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} tickers for a matrix")
    return found


def pivot_close(ticks: DataFrame, tickers: Sequence[str], price: str = "price", order: str = "seq") -> DataFrame:
    """Date x ticker matrix of the last price, for display of a few named tickers."""
    return ticks.groupBy("trade_date").pivot("ticker", list(tickers)).agg(F.max_by(price, order))


def holdings_summary(top_holdings: DataFrame) -> DataFrame:
    """Funds, newest date and mean number of holdings per fund, for every period."""
    per_fund = F.try_divide(F.col("total_holdings").cast("double"), F.col("total_etfs"))
    return (
        top_holdings.groupBy("time_period")
        .agg(
            F.countDistinct("etf_ticker").alias("total_etfs"),
            F.count("*").alias("total_holdings"),
            F.max("as_of_date").alias("as_of_date"),
        )
        .withColumn("avg_holdings_per_etf", F.round(per_fund, 2))
    )


def distinct_tickers(holdings: DataFrame) -> DataFrame:
    """Distinct holding tickers, sorted."""
    named = holdings.filter(F.col("holding_ticker").isNotNull() & (F.col("holding_ticker") != ""))
    return named.select(F.col("holding_ticker").alias("ticker")).distinct().orderBy("ticker")


# ---- leaderboards ---------------------------------------------------------

def _performers(stocks: DataFrame, as_of, days: int) -> DataFrame:
    rows = since(stocks, as_of, days).select("ticker", "company_name", "sector", "trade_date", "close_price")
    return point_return(rows, ("ticker", "company_name", "sector")).select(
        "ticker", "company_name", "sector", "start_price", F.col("end_price").alias("latest_price"),
        "return_pct", F.col("end_date").alias("latest_date"),
    )


def top_performers(stocks: DataFrame, as_of, days: int = 5, k: int = 10) -> DataFrame:
    """Best stocks of the last days."""
    return _performers(stocks, as_of, days).orderBy(F.col("return_pct").desc(), "ticker").limit(k)


def top_performers_by_sector(
    stocks: DataFrame, as_of, days: int = 5, k: int = 2, sector: str | None = None
) -> DataFrame:
    """Best stocks of a sector, or of every sector when none is named."""
    rows = stocks if sector is None else stocks.filter(F.col("sector") == sector)
    return top_k_per_group(
        _performers(rows, as_of, days), ["sector"], [F.col("return_pct").desc(), F.col("ticker")], k
    )


def sector_leaderboard(
    fund_prices: DataFrame, fund_sectors: DataFrame, as_of, periods: Sequence[int] = settings.PERIODS, flagged: int = 2
) -> DataFrame:
    """Sectors ranked by their fund's return in each calendar window; the first two are flagged."""
    gains = calendar_returns(fund_prices, as_of, periods).filter(F.col("day_count") >= 2)
    ranked = global_rank(
        gains.join(fund_sectors, "ticker"), ["period_days"],
        [F.col("return_pct").desc(), F.col("sector"), F.col("ticker")],
    )
    return ranked.select(
        "period_days", "rank", "sector", F.col("ticker").alias("etf"), "return_pct", "start_date", "end_date",
        (F.col("rank") <= flagged).alias("is_trending"),
    )


def leading_sector_stocks(
    leaderboard: DataFrame, stocks: DataFrame, as_of, periods: Sequence[int] = settings.PERIODS, k: int = 2
) -> DataFrame:
    """Best stocks of the flagged sectors, per window."""
    flagged = leaderboard.filter("is_trending").select(
        "period_days", "sector", F.col("return_pct").alias("sector_return")
    )
    gains = calendar_returns(stocks, as_of, periods, keys=("ticker", "company_name", "sector"))
    return top_k_per_group(
        gains.join(flagged, ["period_days", "sector"]), ["period_days", "sector"],
        [F.col("return_pct").desc(), F.col("ticker")], k,
    ).select("period_days", "sector", "sector_return", "rank", "ticker", "company_name", "return_pct")


def fund_performance_table(classified: DataFrame) -> DataFrame:
    """All funds with start and end price, return, category and name, ranked by return.

    ``classified`` comes from ``classify_funds`` over point returns.
    """
    ranked = global_rank(
        classified.filter(F.col("day_count") >= 2).withColumn("board", F.lit("funds")),
        ["board"], [F.col("return_pct").desc(), F.col("ticker")],
    )
    return ranked.select(
        "rank", "ticker", "category", "name", "start_price", "end_price", "return_pct", "start_date", "end_date"
    )


def nest_holdings(rows: DataFrame, keys: Sequence[str], fields: Sequence[str], order: str) -> DataFrame:
    """One row per key with its ranked holdings as an array of structs.

    For rows already cut to a top-k per key, so an array holds at most k items.
    """
    item = F.struct(F.col(order), *[F.col(f) for f in fields if f != order])
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("holdings"))
