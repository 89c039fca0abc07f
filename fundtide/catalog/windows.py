"""Windows, rankings, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundtide.catalog.base import (
    AS_OF, EV, EV_TOP, LI, LI_ALLOC, event_top_holdings, latest_sql, line_allocation, line_stock_allocation, pct,
    point_returns_sql, query, sql,
)
from fundtide.catalog.joins import _SNAPSHOT
from fundtide.catalog.plans import LI_BOARD, line_board
from fundtide.operators import boards, joins, portfolio, ranking, returns, sets, windows
from fundtide.plans import jobs
from fundtide.sources.market import event_market, event_ticks, line_market


def _numbered(source: str, k: int) -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) AS row_num FROM {source}
    QUALIFY row_num <= {k}"""


@query("last_n_rows", sql(LI, _numbered("fund_prices", 5), "ticker d:trade_date f:close_price i:volume i:row_num"))
def last_n_rows(spark, sf_dir):
    return windows.last_n_rows(line_market(spark, sf_dir).fund_prices, 5).select(
        "ticker", "trade_date", "close_price", "volume", "row_num"
    )


@query("top1_per_fund", sql(
    LI_ALLOC, "SELECT * FROM picks",
    "etf_ticker i:period_days ticker company_name sector i:market_cap f:return_pct"))
def top1_per_fund(spark, sf_dir):
    return line_allocation(spark, sf_dir).select(
        "etf_ticker", "period_days", "ticker", "company_name", "sector", "market_cap", "return_pct"
    )


@query("top5_per_fund", sql(EV_TOP, f"""
SELECT etf_ticker, holding_ticker, current_price, rank_position FROM (
  SELECT h.etf_ticker, h.holding_ticker, m.current_price,
    row_number() OVER (PARTITION BY etf_ticker ORDER BY m.total_return DESC, holding_ticker) AS rank_position
  FROM newest_pairs h JOIN metrics m ON m.ticker = h.holding_ticker AND m.period_days = 20) r
WHERE rank_position <= 5""", "etf_ticker holding_ticker f:current_price i:rank_position"))
def top5_per_fund(spark, sf_dir):
    m = event_market(spark, sf_dir)
    pairs = windows.latest_per_key(
        m.positions.select("etf_ticker", "holding_ticker", "as_of_date"), ["etf_ticker", "holding_ticker"], "as_of_date"
    )
    metrics = returns.stock_metrics(m.stored_stock_prices, m.stored_clock, (20,)).withColumnRenamed("ticker", "holding_ticker")
    return windows.top_k_per_group(
        pairs.join(metrics, "holding_ticker"), ["etf_ticker"],
        [F.col("total_return").desc_nulls_last(), F.col("holding_ticker")], 5, "rank_position",
    ).select("etf_ticker", "holding_ticker", "current_price", "rank_position")


# Every third fund tells no percents at all, the next one only those of every other holding.
@query("top_k_by_weight", sql(LI + f"""
snapshot AS ({_SNAPSHOT}),
arrivals AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS fund, CAST(l_partkey AS VARCHAR) AS name,
    CAST(date_trunc('month', d) AS DATE) AS month, min(seq) AS arrival FROM li GROUP BY 1, 2, 3),
told AS (
  SELECT s.etf_ticker, s.holding_ticker, s.as_of_date, a.arrival,
    CASE WHEN CAST(etf_ticker AS BIGINT) % 3 = 0 THEN NULL
      WHEN CAST(etf_ticker AS BIGINT) % 3 = 1 AND CAST(holding_ticker AS BIGINT) % 2 = 0 THEN NULL
      ELSE holding_percent END AS holding_percent
  FROM snapshot s JOIN arrivals a ON a.fund = etf_ticker AND a.name = holding_ticker AND a.month = as_of_date),
usable AS (SELECT * FROM told QUALIFY holding_percent IS NOT NULL OR count(holding_percent) OVER (PARTITION BY etf_ticker) = 0),
""", """
SELECT *, row_number() OVER (PARTITION BY etf_ticker ORDER BY holding_percent DESC NULLS LAST, arrival, holding_ticker) AS rank
FROM usable QUALIFY rank <= 3""", "etf_ticker holding_ticker f:holding_percent d:as_of_date i:rank"))
def top_k_by_weight(spark, sf_dir):
    snapshot = line_market(spark, sf_dir).snapshot
    fund, name = F.col("etf_ticker").cast("bigint") % 3, F.col("holding_ticker").cast("bigint") % 2
    told = F.when((fund == 2) | ((fund == 1) & (name == 1)), F.col("holding_percent"))
    return ranking.top_by_weight(snapshot.withColumn("holding_percent", told), 3, arrival="arrival").select(
        "etf_ticker", "holding_ticker", "holding_percent", "as_of_date", "rank"
    )


@query("month_first_last_value", sql(LI, f"""
SELECT *, {pct('month_close', 'month_open')} AS monthly_return FROM (
  SELECT DISTINCT ticker, date_trunc('month', trade_date) AS month,
    first_value(close_price) OVER w AS month_open, last_value(close_price) OVER w AS month_close
  FROM fund_prices
  WINDOW w AS (PARTITION BY ticker, date_trunc('month', trade_date) ORDER BY trade_date
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) m""",
    "ticker d:month f:month_open f:month_close f:monthly_return"))
def month_first_last_value(spark, sf_dir):
    return windows.month_first_last_value(line_market(spark, sf_dir).fund_prices)


@query("daily_change_pct", sql(
    LI, "SELECT * FROM fund_prices", "ticker d:trade_date f:close_price f:price_change_percent"))
def daily_change_pct(spark, sf_dir):
    return line_market(spark, sf_dir).fund_prices.select(
        "ticker", "trade_date", "close_price", "price_change_percent"
    )


@query("cumulative_return", sql(EV, f"""
SELECT ticker, trade_date, close_price, {pct('close_price', 'base')} AS cum_return FROM (
  SELECT *, first_value(close_price) OVER (PARTITION BY ticker ORDER BY trade_date) AS base FROM fund_prices
  WHERE trade_date >= {AS_OF} - 20) f""", "ticker d:trade_date f:close_price f:cum_return"))
def cumulative_return(spark, sf_dir):
    m = event_market(spark, sf_dir, last_days=20)
    return windows.cumulative_return(windows.since(m.fund_prices, m.clock, 20)).select(
        "ticker", "trade_date", "close_price", "cum_return"
    )


def _top_performers_sql(days: int, k: int) -> str:
    recent = f"(SELECT * FROM stock_prices WHERE trade_date >= {AS_OF} - {days}) w"
    return f"""SELECT ticker, company_name, sector, start_price, end_price AS latest_price, return_pct,
    end_date AS latest_date FROM ({point_returns_sql(recent, 'ticker, company_name, sector')}) g
  ORDER BY return_pct DESC, ticker LIMIT {k}"""


@query("equal_weight_curve", sql(EV + f"""
names AS ({_top_performers_sql(30, 10)}),
held AS (
  SELECT ticker, trade_date, close_price, lag(close_price) OVER (PARTITION BY ticker ORDER BY trade_date) AS previous
  FROM stock_prices WHERE trade_date >= {AS_OF} - 60 AND ticker IN (SELECT ticker FROM names)),
grid AS (
  SELECT d.trade_date, t.ticker, t.start FROM (SELECT DISTINCT trade_date FROM held) d
  JOIN (SELECT ticker, min(trade_date) AS start FROM held GROUP BY 1) t ON true),
daily AS (
  SELECT g.trade_date, COALESCE(avg(CASE WHEN g.trade_date > g.start
    THEN COALESCE((h.close_price - h.previous) / h.previous, 0e0) END), 0e0) AS change
  FROM grid g LEFT JOIN held h ON h.ticker = g.ticker AND h.trade_date = g.trade_date GROUP BY 1),
""", """SELECT trade_date, ln(product(1 + change) OVER (ORDER BY trade_date)) AS log_growth FROM daily""",
    "d:trade_date f:log_growth"))
def equal_weight_curve(spark, sf_dir):
    m = event_market(spark, sf_dir)
    names = boards.top_performers(m.stock_prices, m.clock, 30, 10)
    curve = windows.equal_weight_curve(windows.since(m.stock_prices, m.clock, 60), names)
    # The test values grow by many orders of magnitude, so the curve is compared as a logarithm.
    return curve.select("trade_date", F.log1p(F.col("cum_return") / 100.0).alias("log_growth"))


@query("weighted_portfolio_curve", sql(EV + f"""
names AS (SELECT ticker, return_pct AS weight FROM ({_top_performers_sql(20, 20)}) t),
held AS (
  SELECT s.ticker, trade_date, close_price, weight FROM stock_prices s JOIN names n ON n.ticker = s.ticker
  WHERE trade_date >= {AS_OF} - 20),
base AS (SELECT ticker, close_price AS base_price FROM held WHERE trade_date = (SELECT min(trade_date) FROM held)),
live AS (SELECT sum(weight) AS w FROM (SELECT DISTINCT ticker, weight FROM held) x),
curve AS (
  SELECT trade_date, sum(COALESCE((close_price / base_price - 1) * weight, 0e0)) / (SELECT w FROM live) * 100e0
    AS portfolio_return
  FROM held h LEFT JOIN base b ON b.ticker = h.ticker GROUP BY 1),
reference AS (
  SELECT trade_date, {pct('close_price', 'first_value(close_price) OVER (ORDER BY trade_date)')} AS benchmark_return
  FROM fund_prices WHERE ticker = 'view' AND trade_date >= {AS_OF} - 20),
""", """SELECT COALESCE(c.trade_date, r.trade_date) AS trade_date, portfolio_return, benchmark_return
FROM curve c FULL OUTER JOIN reference r ON r.trade_date = c.trade_date""",
    "d:trade_date f:portfolio_return f:benchmark_return"))
def weighted_portfolio_curve(spark, sf_dir):
    m = event_market(spark, sf_dir, last_days=20)
    names = boards.top_performers(m.stock_prices, m.clock, 20, 20).select(
        "ticker", F.col("return_pct").alias("weight")
    )
    benchmark = m.fund_prices.filter(F.col("ticker") == m.benchmark)
    return windows.weighted_portfolio_curve(
        windows.since(m.stock_prices, m.clock, 20), names, windows.since(benchmark, m.clock, 20)
    )


@query("rank_by_weight", sql(
    LI_ALLOC, "SELECT * FROM alloc", "d:as_of_date i:period_days etf_ticker ticker f:weight i:rank"))
def rank_by_weight(spark, sf_dir):
    return portfolio.rank_by_weight(line_allocation(spark, sf_dir)).select(
        "as_of_date", "period_days", "etf_ticker", "ticker", "weight", "rank"
    )


@query("assign_final_ranks", sql(
    LI_ALLOC, "SELECT * FROM monthly", "d:rebalance_date ticker i:final_rank f:final_weight f:score source_periods"))
def assign_final_ranks(spark, sf_dir):
    scored = portfolio.period_overlap(line_stock_allocation(spark, sf_dir))
    return portfolio.assign_final_ranks(scored).select(
        F.col("as_of_date").alias("rebalance_date"), "ticker", "final_rank", "final_weight", "score", "source_periods"
    )


_WITH_CAPS = LI + f"""
snapshot AS ({_SNAPSHOT}),
recent AS (SELECT * FROM stock_prices WHERE trade_date >= {AS_OF} - 30),
caps AS ({latest_sql('recent', 'ticker', 'trade_date')}),
held AS (SELECT s.*, market_cap FROM snapshot s LEFT JOIN caps c ON c.ticker = s.holding_ticker),
"""


def _snapshot_with_caps(spark, sf_dir):
    m = line_market(spark, sf_dir)
    caps = windows.latest_per_key(
        windows.since(m.stored_stock_prices, m.stored_clock, 30).select("ticker", "trade_date", "market_cap"),
        ["ticker"], "trade_date",
    ).select(F.col("ticker").alias("holding_ticker"), "market_cap")
    return m.newest_pairs.join(caps, "holding_ticker", "left")


@query("mcap_rank_nulls_last", sql(_WITH_CAPS, """
SELECT *, row_number() OVER (PARTITION BY etf_ticker ORDER BY market_cap DESC NULLS LAST, holding_ticker) AS mcap_rank
FROM held QUALIFY mcap_rank <= 5""", "etf_ticker holding_ticker f:market_cap i:mcap_rank"))
def mcap_rank_nulls_last(spark, sf_dir):
    return ranking.market_cap_rank(_snapshot_with_caps(spark, sf_dir), 5).select(
        "etf_ticker", "holding_ticker", F.col("market_cap").cast("double").alias("market_cap"), "mcap_rank"
    )


@query("top_holdings_by_mcap", sql(_WITH_CAPS, """
SELECT *, row_number() OVER (PARTITION BY etf_ticker ORDER BY market_cap DESC, holding_ticker) AS mcap_rank
FROM held WHERE market_cap > 0 QUALIFY mcap_rank <= 5""", "etf_ticker holding_ticker i:market_cap i:mcap_rank"))
def top_holdings_by_mcap(spark, sf_dir):
    return ranking.top_holdings_by_market_cap(_snapshot_with_caps(spark, sf_dir)).select(
        "etf_ticker", "holding_ticker", "market_cap", "mcap_rank"
    )


@query("dual_row_number", sql(EV, """
SELECT ticker, trade_date, close_price, row_number() OVER (PARTITION BY ticker ORDER BY trade_date) AS rn_start,
  row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) AS rn_end FROM stock_prices""",
    "ticker d:trade_date f:close_price i:rn_start i:rn_end"))
def dual_row_number(spark, sf_dir):
    return windows.dual_row_number(event_market(spark, sf_dir).stock_prices).select(
        "ticker", "trade_date", "close_price", "rn_start", "rn_end"
    )


@query("max_over_partition", sql(LI, f"""
SELECT *, max(row_num) OVER (PARTITION BY ticker) AS max_row_num FROM ({_numbered('stock_prices', 20)}) n""",
    "ticker d:trade_date i:row_num i:max_row_num"))
def max_over_partition(spark, sf_dir):
    return windows.with_series_length(line_market(spark, sf_dir).stock_prices, 20).select(
        "ticker", "trade_date", "row_num", "max_row_num"
    )


# ---- top-k ---------------------------------------------------------------------

_PERFORMER_COLUMNS = "ticker company_name sector f:start_price f:latest_price f:return_pct d:latest_date"


@query("top_performers", sql(EV, _top_performers_sql(5, 10), _PERFORMER_COLUMNS))
def top_performers(spark, sf_dir):
    m = event_market(spark, sf_dir, last_days=5)
    return boards.top_performers(m.stock_prices, m.clock, 5, 10)


@query("top_performers_by_sector", sql(EV, f"""
SELECT ticker, company_name, sector, start_price, end_price AS latest_price, return_pct, end_date AS latest_date,
  row_number() OVER (PARTITION BY sector ORDER BY return_pct DESC, ticker) AS rank
FROM ({point_returns_sql(f'(SELECT * FROM stock_prices WHERE trade_date >= {AS_OF} - 5) w',
                         'ticker, company_name, sector')}) g
QUALIFY rank <= 2""", _PERFORMER_COLUMNS + " i:rank"))
def top_performers_by_sector(spark, sf_dir):
    m = event_market(spark, sf_dir, last_days=5)
    return boards.top_performers_by_sector(m.stock_prices, m.clock)


def _periods_of(source: str) -> str:
    return f"(SELECT s.*, p AS period_days FROM {source} s JOIN (VALUES (5), (10), (20)) v(p) " \
        f"ON trade_date >= {AS_OF} - p) w"


_LEADERBOARD = EV + f"""
fund_gains AS ({point_returns_sql(_periods_of('fund_prices'), 'ticker, period_days')}),
leaderboard AS (
  SELECT period_days, row_number() OVER (PARTITION BY period_days ORDER BY return_pct DESC, sector_name) AS rank,
    sector_name AS sector, g.ticker AS etf, return_pct, start_date, end_date
  FROM fund_gains g JOIN fund_meta m ON m.ticker = g.ticker AND sector_name IS NOT NULL WHERE day_count >= 2),
stock_gains AS ({point_returns_sql(_periods_of('stock_prices'), 'ticker, company_name, sector, period_days')}),
"""


def _leaderboard(spark, sf_dir):
    m = event_market(spark, sf_dir, last_days=20)
    sectors = m.fund_meta.filter(F.col("sector_name").isNotNull()).select(
        "ticker", F.col("sector_name").alias("sector")
    )
    return boards.sector_leaderboard(m.fund_prices, sectors, m.clock)


@query("sector_leaderboard", sql(
    _LEADERBOARD, "SELECT *, rank <= 2 AS is_trending FROM leaderboard",
    "i:period_days i:rank sector etf f:return_pct d:start_date d:end_date is_trending"))
def sector_leaderboard(spark, sf_dir):
    return _leaderboard(spark, sf_dir)


@query("leading_sector_stocks", sql(_LEADERBOARD, """
SELECT s.period_days, s.sector, l.return_pct AS sector_return, ticker, company_name, s.return_pct,
  row_number() OVER (PARTITION BY s.period_days, s.sector ORDER BY s.return_pct DESC, ticker) AS rank
FROM stock_gains s JOIN leaderboard l ON l.period_days = s.period_days AND l.sector = s.sector AND l.rank <= 2
QUALIFY row_number() OVER (PARTITION BY s.period_days, s.sector ORDER BY s.return_pct DESC, ticker) <= 2""",
    "i:period_days sector f:sector_return i:rank ticker company_name f:return_pct"))
def leading_sector_stocks(spark, sf_dir):
    m = event_market(spark, sf_dir, last_days=20)
    return boards.leading_sector_stocks(_leaderboard(spark, sf_dir), m.stock_prices, m.clock)


@query("multi_key_order", sql(
    LI_BOARD, "SELECT * FROM board", "etf_ticker is_benchmark f:etf_return_pct i:mcap_rank holding_ticker"))
def multi_key_order(spark, sf_dir):
    return jobs.ordered_board(line_board(spark, sf_dir)).select(
        "etf_ticker", "is_benchmark", "etf_return_pct", "mcap_rank", "holding_ticker"
    )


@query("limit_funds", sql(EV_TOP, """
SELECT * FROM top_holdings WHERE time_period = 20
  AND etf_ticker IN (SELECT DISTINCT etf_ticker FROM top_holdings WHERE time_period = 20 ORDER BY 1 LIMIT 3)""",
    "etf_ticker i:rank_position holding_ticker f:total_return"))
def limit_funds(spark, sf_dir):
    rows = event_top_holdings(spark, sf_dir, stored=True).filter("time_period = 20")
    return ranking.limit_groups(rows, "etf_ticker", 3).select(
        "etf_ticker", "rank_position", "holding_ticker", "total_return"
    )


def _window_return(condition: str) -> str:
    first, last = (f"arg_{x}(close_price, trade_date) FILTER ({condition})" for x in ("min", "max"))
    return f"CASE WHEN count(*) FILTER ({condition}) >= 2 THEN COALESCE({pct(last, first)}, 0e0) ELSE 0e0 END"


@query("period_over_period", sql(LI, f"""
SELECT *, current_return - prev_return AS change FROM (
  SELECT ticker, {_window_return(f'trade_date <= {AS_OF} - 20')} AS prev_return,
    {_window_return(f'trade_date > {AS_OF} - 20')} AS current_return
  FROM fund_prices WHERE trade_date > {AS_OF} - 40 GROUP BY ticker) w""",
    "ticker f:prev_return f:current_return f:change"))
def period_over_period(spark, sf_dir):
    m = line_market(spark, sf_dir, last_days=40)
    return returns.period_over_period(m.fund_prices, m.clock, 20)


# ---- set operations --------------------------------------------------------------

@query("union_by_name", sql(LI_ALLOC, """
SELECT ticker, period_days, portfolio_weight, 'held' AS kind FROM stock_alloc WHERE period_days = 20
UNION ALL
SELECT ticker, period_days, NULL, 'new' FROM stock_alloc WHERE period_days <> 20""",
    "ticker i:period_days f:portfolio_weight kind"))
def union_by_name(spark, sf_dir):
    rows = line_stock_allocation(spark, sf_dir)
    held = rows.filter("period_days = 20").select("ticker", "period_days", "portfolio_weight", F.lit("held").alias("kind"))
    new = rows.filter("period_days <> 20").select(F.lit("new").alias("kind"), "period_days", "ticker")
    return sets.union_by_name(held, new)


@query("distinct_rows", sql(
    LI, "SELECT DISTINCT holding_ticker, as_of_date FROM holdings", "holding_ticker d:as_of_date"))
def distinct_rows(spark, sf_dir):
    return sets.distinct_rows(line_market(spark, sf_dir).positions, ["holding_ticker", "as_of_date"])


@query("dedup_by_key", """
SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(CAST(ts AS DATE) AS VARCHAR) AS trade_date,
  'S' || CAST(user_id % 5 AS VARCHAR) AS sector FROM events GROUP BY ALL""")
def dedup_by_key(spark, sf_dir):
    ticks = event_ticks(spark, sf_dir).select("ticker", "trade_date", "sector")
    return sets.dedup_by_key(ticks, ["ticker", "trade_date"])


@query("union_universe", sql(LI, """
SELECT ticker, etf_type, COALESCE(sector_name, 'none') AS sector_name FROM fund_meta
WHERE ticker IN (SELECT ticker FROM fund_prices GROUP BY 1 HAVING count(*) >= 460)""",
    "ticker etf_type sector_name"))
def union_universe(spark, sf_dir):
    m = line_market(spark, sf_dir)
    busy = m.fund_prices.groupBy("ticker").agg(F.count("*").alias("n")).filter("n >= 460")
    return sets.union_universe(
        m.fund_meta.filter("etf_type = 'benchmark'"), m.fund_meta.filter("etf_type = 'sector'"), busy
    ).withColumn("sector_name", F.coalesce("sector_name", F.lit("none")))
