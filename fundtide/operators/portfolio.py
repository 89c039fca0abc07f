"""Trend flags, allocations and the monthly merge of the three portfolios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundtide import settings
from fundtide.functions.columns import is_trending
from fundtide.functions.dates import day
from fundtide.operators.joins import returns_with_holdings
from fundtide.operators.ranking import global_rank
from fundtide.operators.windows import top_k_per_group
from fundtide.sources.workspace import materialized


def with_benchmark(returns: DataFrame, benchmark: str, on_missing: str = "error") -> DataFrame:
    """Add the benchmark's return of the same period and drop the benchmark's own rows.

    ``on_missing``: ``"error"`` fails the job when a period has no benchmark,
    ``"zero"`` compares with 0.
    """
    # One row per period: the periods are a short literal list.
    reference = F.broadcast(
        returns.filter(F.col("ticker") == benchmark)
        .groupBy("period_days")
        .agg(F.max("return_pct").alias("benchmark_return"))
    )
    if on_missing == "error":
        instead: Column = F.raise_error(F.lit(f"no return for benchmark {benchmark}")).cast("double")
    elif on_missing == "zero":
        instead = F.lit(0.0)
    else:
        raise ValueError(f"on_missing must be 'error' or 'zero', not {on_missing!r}")
    return (
        returns.filter(F.col("ticker") != benchmark)
        .join(reference, "period_days", "left")
        .withColumn("benchmark_return", F.coalesce("benchmark_return", instead))
    )


def flag_trending(returns: DataFrame, benchmark: str, on_missing: str = "error") -> DataFrame:
    """Funds that are positive and beat the benchmark."""
    return with_benchmark(returns, benchmark, on_missing).withColumn(
        "is_trending", is_trending(F.col("return_pct"), F.col("benchmark_return"))
    )


def sector_trending(
    fund_returns: DataFrame, fund_sectors: DataFrame, benchmark: str, as_of, on_missing: str = "zero"
) -> DataFrame:
    """Sector funds against the benchmark, with the month the record belongs to.

    ``fund_sectors`` is (ticker, sector).
    """
    end = day(as_of)
    return (
        flag_trending(fund_returns, benchmark, on_missing)
        .join(fund_sectors, "ticker")
        .select(
            end.alias("as_of_date"),
            F.year(end).alias("year"), F.month(end).alias("month"),
            "sector", "return_pct", "benchmark_return", "period_days", "is_trending",
        )
    )


def stock_vs_sector(stocks_with_sector_avg: DataFrame, as_of) -> DataFrame:
    """Stocks of trending sectors against their sector's return."""
    end = day(as_of)
    return stocks_with_sector_avg.select(
        end.alias("as_of_date"),
        F.year(end).alias("year"), F.month(end).alias("month"),
        "ticker", "company_name", "sector", "market_cap", "return_pct", "sector_avg", "period_days",
        (F.col("return_pct") - F.col("sector_avg")).alias("vs_sector"),
        (F.col("return_pct") > F.col("sector_avg")).alias("is_trending"),
    )


def best_per_fund(candidates: DataFrame) -> DataFrame:
    """Best performer of every fund and period."""
    return top_k_per_group(
        candidates, ["etf_ticker", "period_days"], [F.col("return_pct").desc(), F.col("ticker")], 1, "_n"
    ).drop("_n")


def weigh_by_score(picks: DataFrame) -> DataFrame:
    """Weight in percent: score over the portfolio's total, equal weights when the total is 0 or NULL.

    A portfolio is one (as_of_date, period_days); there are at most three per
    trading day, so their totals are a small table.
    """
    portfolio = ["as_of_date", "period_days"]
    totals = F.broadcast(
        picks.groupBy(*portfolio).agg(
            F.sum("allocation_score").alias("_total"), F.count("*").alias("_members")
        )
    )
    equal = F.lit(100.0) / F.col("_members")
    share = F.try_divide(F.col("allocation_score"), F.col("_total")) * F.lit(100.0)
    usable = F.coalesce(F.col("_total") != 0, F.lit(False))
    return (
        picks.join(totals, portfolio)
        .withColumn("weight", F.when(usable, share).otherwise(equal))
        .drop("_total", "_members")
    )


def rank_by_weight(portfolio: DataFrame) -> DataFrame:
    """Rank inside each (date, period) by weight, ties by fund."""
    return global_rank(
        portfolio, ["as_of_date", "period_days"], [F.col("weight").desc(), F.col("etf_ticker")]
    )


def allocate(
    stock_returns: DataFrame,
    holdings: DataFrame,
    trending: DataFrame,
    as_of,
    min_score: float | None = None,
    ranked: bool = True,
) -> DataFrame:
    """Best stock of every trending fund, weighted by return over market cap.

    ``stock_returns``: ticker, period_days, return_pct and the newest company_name,
    sector, market_cap; ``holdings``: etf_ticker, holding_ticker; ``trending``:
    etf_ticker, one row per fund.  One row per (fund, period).
    """
    known = stock_returns.filter(F.col("market_cap") > 0)
    candidates = returns_with_holdings(known, holdings.join(trending, "etf_ticker", "left_semi"))
    picks = best_per_fund(candidates).withColumns({
        "as_of_date": day(as_of),
        "allocation_score": F.col("return_pct") * (F.lit(1.0) / F.col("market_cap")),
        "allocation_reason": F.format_string(settings.ALLOCATION_REASON, F.col("period_days")),
    })
    if min_score is not None:
        picks = picks.filter(F.col("allocation_score") >= min_score)
    # Totals and rows both need the picks; written once, the joins behind them run once.
    weighted = weigh_by_score(materialized(picks, "picks"))
    return rank_by_weight(weighted) if ranked else weighted


def roll_up_by_stock(allocation: DataFrame) -> DataFrame:
    """Allocation per stock: a stock picked by several funds gets the sum of their weights."""
    best_rank = [F.min("rank").alias("rank")] if "rank" in allocation.columns else []
    return allocation.groupBy("as_of_date", "period_days", "ticker").agg(
        F.max("company_name").alias("company_name"),
        F.max("sector").alias("sector"),
        F.max("market_cap").alias("market_cap"),
        F.max("return_pct").alias("return_pct"),
        (F.sum("weight") / 100.0).alias("portfolio_weight"),
        F.max("allocation_reason").alias("allocation_reason"),
        F.count("*").alias("fund_count"),
        *best_rank,
    )


def period_overlap(allocations: DataFrame) -> DataFrame:
    """Score every stock by the 5/10/20-day portfolios it is in.

    The classes exclude each other: in the 20-day portfolio (a point more for each
    shorter one), in both shorter ones, in the 10-day one only, in the 5-day one
    only.  Attributes come from the 20-day row, else the 5-day, else the 10-day.
    """
    def of(period: int, column: str) -> Column:
        return F.max(F.when(F.col("period_days") == period, F.col(column)))

    def best(column: str) -> Column:
        return F.coalesce(of(20, column), of(5, column), of(10, column))

    merged = allocations.groupBy("as_of_date", "ticker").agg(
        best("company_name").alias("company_name"),
        best("sector").alias("sector"),
        best("market_cap").alias("market_cap"),
        best("return_pct").alias("return_20"),
        best("allocation_reason").alias("allocation_reason"),
        of(20, "portfolio_weight").alias("weight_20"),
        of(10, "portfolio_weight").alias("weight_10"),
        of(5, "portfolio_weight").alias("weight_5"),
    )
    in_20, in_10, in_5 = (F.col(f"weight_{p}").isNotNull() for p in (20, 10, 5))
    points = settings.OVERLAP_SCORES
    extra = F.when(in_10, points["also_10d"]).otherwise(0.0) + F.when(in_5, points["also_5d"]).otherwise(0.0)
    score = (
        F.when(in_20, F.lit(points["base_20d"]) + extra)
        .when(in_10 & in_5, points["10d_and_5d"])
        .when(in_10, points["10d_only"])
        .otherwise(points["5d_only"])
    )
    return merged.withColumns({
        "score": score,
        "is_new": ~in_20,
        "source_periods": F.concat_ws(",", F.when(in_20, "20d"), F.when(in_10, "10d"), F.when(in_5, "5d")),
    })


def assign_final_ranks(
    scored: DataFrame,
    size: int = settings.PORTFOLIO_SIZE,
    first_new: int = settings.NEW_NAME_FIRST_RANK,
) -> DataFrame:
    """The final ``size`` names per date, ranked and weighted by score.

    Names of the 20-day portfolio keep their overall rank, new names are numbered
    from ``first_new`` on, and the two are merged by that number (existing first
    on a tie).  Only the best ``size`` existing and ``size + first_new - 1`` new
    names can influence the outcome: an existing name behind more new names than
    that has a number beyond every new name that could still be chosen.  So the
    rows are cut per class first, and no date is ever sorted as a whole.
    """
    best_first = [F.col("score").desc(), F.col("return_20").desc(), F.col("ticker")]
    date = ["as_of_date"]
    # One window for both classes; the existing ones are cut further by their rank.
    own = top_k_per_group(scored, [*date, "is_new"], best_first, size + first_new - 1, "own_rank")

    per_day = Window.partitionBy(*date)
    merged = own.filter(F.col("is_new") | (F.col("own_rank") <= size)).withColumn(
        "overall_rank", F.row_number().over(per_day.orderBy(*best_first))
    ).withColumn(
        "adjusted_rank",
        F.when(F.col("is_new"), F.col("own_rank") + F.lit(first_new - 1)).otherwise(F.col("overall_rank")),
    )
    final = top_k_per_group(
        merged, date, [F.col("adjusted_rank"), F.col("is_new"), F.col("ticker")], size, "final_rank"
    )
    return final.withColumn("final_weight", F.try_divide(F.col("score"), F.sum("score").over(per_day))).drop(
        "own_rank", "overall_rank", "adjusted_rank"
    )
