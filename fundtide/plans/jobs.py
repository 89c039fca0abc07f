"""The batch jobs: trend, allocation, top holdings, monthly rebalance, board, views, work list.

Each is one plan over all periods; nothing is collected.  The only actions write
small intermediate results that several branches need - a few rows per fund, or
the range-sorted rows behind a full ranking - to the shared folder, so that the
history behind them is read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtide import settings
from fundtide.functions import columns as C
from fundtide.functions.dates import day
from fundtide.operators import boards, filters, joins, portfolio, ranking, returns
from fundtide.operators.windows import latest_per_key, since, top_k_per_group
from fundtide.sources.workspace import materialized


def _recent(bars: DataFrame, as_of, period: int, slack_days: int | None) -> DataFrame:
    return bars if slack_days is None else since(bars, as_of, period + slack_days)


def trending_funds(
    fund_prices: DataFrame,
    meta: DataFrame | None,
    benchmark: str,
    as_of,
    periods: Sequence[int] = (20,),
    slack_days: int | None = settings.SLACK_DAYS,
    kind: str = "range",
    on_missing: str = "error",
    ranked: bool = True,
) -> DataFrame:
    """Every fund but the benchmark with its period return, the benchmark's, a flag and a rank.

    ``slack_days`` widens the calendar pre-filter of a period; None reads all
    history, for series with long gaps.  Without ``meta`` type and sector are left out.
    """
    end = day(as_of)
    bars = _recent(fund_prices, as_of, max(periods), slack_days)
    # A few rows per fund, needed for the funds and for the benchmark: written once, history is read once.
    gains = materialized(returns.period_returns(bars, periods, kind), "fund-returns")
    flagged = portfolio.flag_trending(gains, benchmark, on_missing)
    described = [] if meta is None else ["etf_type", "sector_name"]
    if meta is not None:
        flagged = joins.prices_with_meta(flagged, meta)
    flagged = flagged.select(
        end.alias("as_of_date"), F.col("ticker").alias("etf_ticker"), *described,
        "return_pct", "benchmark_return", "is_trending", "period_days",
    )
    if not ranked:
        return flagged
    return ranking.global_rank(
        flagged, ["as_of_date", "period_days"], [F.col("return_pct").desc(), F.col("etf_ticker")]
    )


def portfolio_allocation(
    trending: DataFrame,
    holdings: DataFrame,
    stocks: DataFrame,
    as_of,
    periods: Sequence[int] = settings.PERIODS,
    slack_days: int | None = settings.SLACK_DAYS,
    holding_days: int = 30,
    kind: str = "range",
    ranked: bool = True,
) -> DataFrame:
    """One portfolio per period: the best stock of every trending fund, weighted.

    ``trending`` is (etf_ticker, is_trending).  One row per fund and period; use
    ``roll_up_by_stock`` for the stored per-stock form.
    """
    recent = _recent(stocks, as_of, max(periods), slack_days)
    usable = filters.valid_instruments(filters.known_sector(recent), "ticker", "company_name")
    pairs = filters.valid_instruments(
        holdings.filter(F.col("as_of_date") >= day(as_of, holding_days))
        .select("etf_ticker", "holding_ticker").distinct(),
        "holding_ticker",
    )
    attributes = ["company_name", "sector", "market_cap"]
    gains = returns.period_returns(usable, periods, kind, carry=attributes)
    return portfolio.allocate(
        gains.select("ticker", "period_days", "return_pct", *attributes),
        pairs,
        trending.filter("is_trending").select("etf_ticker"),
        as_of,
        ranked=ranked,
    )


def fund_top_holdings(
    meta: DataFrame,
    holdings: DataFrame,
    stocks: DataFrame,
    as_of,
    periods: Sequence[int] = settings.PERIODS,
    k: int = settings.TOP_HOLDINGS,
    etf_type: str | None = None,
) -> DataFrame:
    """Best ``k`` holdings of every fund by total return, for every period."""
    end = day(as_of)
    funds = meta if etf_type is None else meta.filter(F.col("etf_type") == etf_type)
    pairs = latest_per_key(
        holdings.select("etf_ticker", "holding_ticker", "holding_name", "holding_percent", "as_of_date"),
        ["etf_ticker", "holding_ticker"], "as_of_date",
    )
    combined = joins.holdings_meta_metrics(pairs, funds, returns.stock_metrics(stocks, as_of, periods))
    best = top_k_per_group(
        combined, ["etf_ticker", "period_days"],
        [F.col("total_return").desc_nulls_last(), F.col("holding_ticker")], k, "rank_position",
    )
    return best.select(
        "etf_ticker", "etf_type", "sector_name", "holding_ticker",
        F.coalesce("holding_name", "listed_name").alias("holding_name"), "holding_sector",
        F.col("period_days").alias("time_period"), "rank_position",
        "avg_return", "total_return", "volatility", "avg_volume", "current_price", "market_cap",
        end.alias("as_of_date"),
    )


def monthly_rebalance(
    allocations: DataFrame,
    as_of=None,
    periods: Sequence[int] = settings.PERIODS,
    size: int = settings.PORTFOLIO_SIZE,
    only_last_sunday: bool = False,
) -> DataFrame:
    """Merge the portfolios of a date (default: the newest) into the monthly one.

    Empty when any period has no portfolio on that date.  ``allocations`` is per
    stock, as ``roll_up_by_stock`` gives it.
    """
    date = allocations.agg(F.max("as_of_date").alias("d")).scalar() if as_of is None else day(as_of)
    slices = allocations.filter((F.col("as_of_date") == date) & F.col("period_days").isin(*periods))
    complete = slices.agg((F.countDistinct("period_days") == len(periods)).alias("c")).scalar()
    chosen = slices.filter(complete)
    if only_last_sunday:
        chosen = chosen.filter(C.is_last_sunday(F.col("as_of_date")))
    final = portfolio.assign_final_ranks(portfolio.period_overlap(chosen), size)
    return final.select(
        "ticker", "company_name", "sector", "final_rank", "final_weight", "score", "source_periods",
        F.col("return_20").alias("return_20d"), "market_cap", "allocation_reason",
        F.col("as_of_date").alias("rebalance_date"),
        F.date_add("as_of_date", settings.VALID_DAYS).alias("valid_until"),
    )


def trending_top_holdings_board(
    fund_prices: DataFrame,
    stocks: DataFrame,
    holdings: DataFrame,
    as_of,
    days: int = 20,
    k: int = 5,
    benchmark: str = settings.MAIN_BENCHMARK,
    benchmark_funds: Sequence[str] = settings.BENCHMARK_FUNDS,
) -> DataFrame:
    """Largest holdings of every benchmark and trending fund, with fund and stock returns."""
    fund_gain = materialized(
        returns.point_return(
            since(fund_prices, as_of, days).select("ticker", "trade_date", "close_price")
        ).select("ticker", "return_pct"),
        "fund-returns",
    )
    reference = fund_gain.filter(F.col("ticker") == benchmark).agg(F.max("return_pct").alias("r")).scalar()
    beats = (F.col("ticker") != benchmark) & C.is_trending(
        F.col("return_pct"), F.coalesce(reference, F.lit(0.0))
    )
    targets = fund_gain.select(
        F.col("ticker").alias("etf_ticker"), F.col("return_pct").alias("etf_return_pct"),
        F.col("ticker").isin(*benchmark_funds).alias("is_benchmark"),
        F.coalesce(beats, F.lit(False)).alias("is_trending"),
    ).filter(F.col("is_benchmark") | F.col("is_trending"))

    held = joins.latest_snapshot(
        holdings.select("etf_ticker", "holding_ticker", "holding_name", "as_of_date")
    ).join(targets, "etf_ticker")
    known = returns.latest_and_return(since(stocks, as_of, days))
    board = joins.holdings_left_mcap_returns(held, known)
    return ranking.market_cap_rank(board, k).select(
        "etf_ticker", "etf_return_pct", "is_benchmark", "is_trending", "holding_ticker", "holding_name",
        "market_cap", "trade_date", "as_of_date", "mcap_rank", "holding_return_pct",
    )


def portfolio_pick(
    board: DataFrame, priority: Sequence[str] = settings.BENCHMARK_PRIORITY
) -> DataFrame:
    """The best performer on the board's trending funds and the fund to show it under."""
    best = (
        board.filter("is_trending").filter(F.col("holding_return_pct").isNotNull())
        .orderBy(
            F.col("holding_return_pct").desc(), F.coalesce("market_cap", F.lit(0)).desc(),
            "holding_ticker", "etf_ticker",
        )
        .limit(1)
    )
    return joins.pick_source_fund(best, board.filter("is_benchmark"), priority)


def ordered_board(board: DataFrame) -> DataFrame:
    """Benchmarks first, then by fund return, fund and rank."""
    return board.orderBy(
        F.col("is_benchmark").desc(), F.col("etf_return_pct").desc_nulls_last(), "etf_ticker", "mcap_rank"
    )


def nested_board(board: DataFrame) -> DataFrame:
    """One row per fund with its holdings as an array."""
    return boards.nest_holdings(
        board, ["etf_ticker", "etf_return_pct", "is_benchmark", "is_trending"],
        ["mcap_rank", "holding_ticker", "holding_name", "market_cap", "holding_return_pct"], "mcap_rank",
    )


# ---- read models ------------------------------------------------------------

def _newest(df: DataFrame, date: str, as_of=None) -> DataFrame:
    newest = df.agg(F.max(date).alias("d")).scalar() if as_of is None else day(as_of)
    return df.filter(F.col(date) == newest)


def latest_date_rows(df: DataFrame, date: str, group: Sequence[str] = ()) -> DataFrame:
    """Rows at the newest date: overall, or of each group."""
    if not group:
        return _newest(df, date)
    return df.join(df.groupBy(*group).agg(F.max(date).alias(date)), [*group, date])


def allocation_view(allocations: DataFrame, period: int = 20, as_of=None) -> DataFrame:
    """Portfolio of one period at a date (default: the newest), weights in percent."""
    rows = _newest(allocations.filter(F.col("period_days") == period), "as_of_date", as_of)
    return rows.withColumn("weight", F.col("portfolio_weight") * 100.0).orderBy(
        F.col("portfolio_weight").desc(), "ticker"
    )


def monthly_view(monthly: DataFrame, rebalance_date=None) -> DataFrame:
    """Monthly portfolio at a date (default: the newest), weights in percent."""
    return _newest(monthly, "rebalance_date", rebalance_date).select(
        "rebalance_date", "valid_until", "ticker", "company_name", "sector",
        F.col("final_rank").alias("rank"), (F.col("final_weight") * 100.0).alias("weight"),
        "score", "source_periods", F.col("return_20d").alias("return_pct"), "market_cap", "allocation_reason",
    ).orderBy("rank")


def monthly_totals(view: DataFrame) -> DataFrame:
    """Header of the monthly view: dates, number of names and total weight."""
    return view.groupBy("rebalance_date", "valid_until").agg(
        F.count("*").alias("total_stocks"), F.round(F.sum("weight"), 2).alias("total_weight")
    )


def fund_holdings_view(
    top_holdings: DataFrame, fund: str | None = None, period: int | None = None, etf_type: str | None = None
) -> DataFrame:
    """Ranked holdings of one fund or of all, at each fund's newest date."""
    rows = top_holdings
    if fund is not None:
        rows = rows.filter(F.col("etf_ticker") == fund.upper())
    if period is not None:
        rows = rows.filter(F.col("time_period") == period)
    if etf_type is not None:
        rows = rows.filter(F.col("etf_type") == etf_type)
    return latest_date_rows(rows, "as_of_date", ["etf_ticker"])


def collection_worklist(
    trending: DataFrame, holdings: DataFrame, stocks: DataFrame, as_of, k: int = settings.TOP_HOLDINGS
) -> DataFrame:
    """Stocks still to collect: top holdings of the trending funds without a bar on the day."""
    end = day(as_of)
    snapshot = joins.latest_snapshot(filters.in_set(holdings, trending.filter("is_trending"), "etf_ticker"))
    top = top_k_per_group(
        snapshot, ["etf_ticker"],
        [F.col("holding_percent").desc_nulls_last(), F.col("holding_ticker"), F.col("holding_name")], k, "_n",
    )
    given = F.when(F.col("holding_ticker") != "", F.col("holding_ticker"))
    wanted = top.select(
        F.coalesce(given, C.ticker_from_name(F.col("holding_name"))).alias("ticker")
    ).filter(F.col("ticker").isNotNull()).distinct()
    present = stocks.filter(F.col("trade_date") == end).select("ticker")
    return wanted.join(present, "ticker", "left_anti")
