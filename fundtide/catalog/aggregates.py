"""Aggregations and boards."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundtide.catalog.base import (
    AS_OF, EV, EV_TOP, LI, LI_ALLOC, event_top_holdings, latest_sql, line_allocation, line_stock_allocation, pct,
    period_returns_sql, point_returns_sql, query, sql,
)
from fundtide.operators import boards, portfolio, returns
from fundtide.operators.windows import latest_per_key
from fundtide.plans import jobs
from fundtide.sources.market import EVENT_FUNDS, event_market, event_ticks, line_market
from fundtide.sources.workspace import materialized


@query("range_return", sql(LI + f"gains AS ({period_returns_sql('fund_prices', (20,))}),", "SELECT * FROM gains",
    "ticker i:period_days f:return_pct d:first_date d:last_date i:day_count"))
def range_return(spark, sf_dir):
    return returns.range_return(line_market(spark, sf_dir).fund_prices, 20).select(
        "ticker", "period_days", "return_pct", "first_date", "last_date", "day_count"
    )


@query("point_return", sql(LI + f"gains AS ({point_returns_sql('stock_prices')}),", "SELECT * FROM gains",
    "ticker f:start_price f:end_price d:start_date d:end_date i:day_count f:return_pct"))
def point_return(spark, sf_dir):
    return returns.point_return(line_market(spark, sf_dir).stock_prices)


@query("multi_period_return", sql(LI + f"""
ranged AS ({period_returns_sql('stock_prices')}),
pointed AS ({period_returns_sql('stock_prices', kind='point')}),
""", """SELECT r.ticker, r.period_days, r.day_count, r.return_pct AS range_return, p.return_pct AS point_return
FROM ranged r JOIN pointed p ON p.ticker = r.ticker AND p.period_days = r.period_days""",
    "ticker i:period_days i:day_count f:range_return f:point_return"))
def multi_period_return(spark, sf_dir):
    return returns.range_and_point_returns(line_market(spark, sf_dir).stock_prices)


@query("stock_metrics", sql(
    EV_TOP, "SELECT * FROM metrics",
    "ticker i:period_days holding_name holding_sector f:current_price i:market_cap f:avg_return f:volatility "
    "i:avg_volume i:trading_days f:total_return"))
def stock_metrics(spark, sf_dir):
    m = event_market(spark, sf_dir)
    return returns.stock_metrics(m.stored_stock_prices, m.stored_clock)


@query("sector_summary_7d", sql(EV, f"""
SELECT sector, avg(price_change_percent) AS avg_change_pct, count(*) AS row_count,
  count(DISTINCT ticker) AS stock_count, sum(volume) AS total_volume, max(trade_date) AS latest_date,
  avg(price_change_percent) > 0 AS is_trending
FROM stock_prices WHERE trade_date >= {AS_OF} - 7 GROUP BY sector""",
    "sector f:avg_change_pct i:row_count i:stock_count i:total_volume d:latest_date is_trending"))
def sector_summary_7d(spark, sf_dir):
    m = event_market(spark, sf_dir)
    return boards.sector_summary(m.stored_stock_prices, m.stored_clock)


@query("sector_point_in_time", sql(EV + f"""
newest AS ({latest_sql('fund_prices', 'ticker', 'trade_date')}),
counts AS (SELECT sector, count(*) AS row_count, count(DISTINCT ticker) AS stock_count FROM stock_prices GROUP BY 1),
""", """SELECT sector_name AS sector, n.ticker, price_change_percent AS avg_change_percent,
  COALESCE(row_count, 0) AS row_count, COALESCE(stock_count, 0) AS stock_count, price_change_percent > 0 AS is_trending
FROM newest n JOIN fund_meta m ON m.ticker = n.ticker AND etf_type = 'sector'
LEFT JOIN counts c ON c.sector = sector_name""",
    "sector ticker f:avg_change_percent i:row_count i:stock_count is_trending"))
def sector_point_in_time(spark, sf_dir):
    m = event_market(spark, sf_dir)
    return boards.sector_point_in_time(m.fund_meta, m.fund_prices, m.stock_prices)


@query("monthly_return", sql(LI, f"""
SELECT *, {pct('month_close', 'month_open')} AS monthly_return FROM (
  SELECT ticker, date_trunc('month', trade_date) AS month, arg_min(close_price, trade_date) AS month_open,
    arg_max(close_price, trade_date) AS month_close FROM fund_prices GROUP BY 1, 2) m""",
    "ticker d:month f:month_open f:month_close f:monthly_return"))
def monthly_return(spark, sf_dir):
    return returns.monthly_return(line_market(spark, sf_dir).fund_prices)


@query("latest_row_per_key", sql(
    LI, latest_sql("stock_prices", "ticker", "trade_date"),
    "ticker company_name sector d:trade_date f:close_price f:price_change_percent i:volume i:market_cap"))
def latest_row_per_key(spark, sf_dir):
    return latest_per_key(line_market(spark, sf_dir).stock_prices, ["ticker"], "trade_date").select(
        "ticker", "company_name", "sector", "trade_date", "close_price", "price_change_percent", "volume", "market_cap"
    )


@query("latest_holding_pair", sql(
    LI, latest_sql("holdings", "etf_ticker, holding_ticker", "as_of_date"),
    "etf_ticker holding_ticker holding_name f:holding_percent i:holding_shares d:as_of_date"))
def latest_holding_pair(spark, sf_dir):
    return latest_per_key(
        line_market(spark, sf_dir).holdings, ["etf_ticker", "holding_ticker"], "as_of_date"
    ).select("etf_ticker", "holding_ticker", "holding_name", "holding_percent", "holding_shares", "as_of_date")


@query("latest_date_filter", sql(LI, """
SELECT 'overall' AS scope, etf_ticker, holding_ticker, as_of_date FROM holdings
WHERE as_of_date = (SELECT max(as_of_date) FROM holdings)
UNION ALL
SELECT 'stock', etf_ticker, holding_ticker, as_of_date FROM holdings h
WHERE as_of_date = (SELECT max(as_of_date) FROM holdings x WHERE x.holding_ticker = h.holding_ticker)""",
    "scope etf_ticker holding_ticker d:as_of_date"))
def latest_date_filter(spark, sf_dir):
    # Read by four branches: the pairs are written once.
    holdings = materialized(
        line_market(spark, sf_dir).positions.select("etf_ticker", "holding_ticker", "as_of_date"), "pairs")
    columns = ["scope", "etf_ticker", "holding_ticker", "as_of_date"]
    overall = jobs.latest_date_rows(holdings, "as_of_date").withColumn("scope", F.lit("overall"))
    by_stock = jobs.latest_date_rows(holdings, "as_of_date", ["holding_ticker"]).withColumn("scope", F.lit("stock"))
    return overall.select(*columns).unionByName(by_stock.select(*columns))


@query("distinct_tickers", sql(LI, "SELECT DISTINCT holding_ticker AS ticker FROM holdings", "ticker"))
def distinct_tickers(spark, sf_dir):
    return boards.distinct_tickers(line_market(spark, sf_dir).positions)


@query("holdings_summary", sql(EV_TOP, """
SELECT time_period, count(DISTINCT etf_ticker) AS total_etfs, count(*) AS total_holdings,
  max(as_of_date) AS as_of_date, round(count(*) / CAST(count(DISTINCT etf_ticker) AS DOUBLE), 2) AS avg_holdings_per_etf
FROM top_holdings GROUP BY time_period""",
    "i:time_period i:total_etfs i:total_holdings d:as_of_date f:avg_holdings_per_etf"))
def holdings_summary(spark, sf_dir):
    return boards.holdings_summary(event_top_holdings(spark, sf_dir))


@query("period_overlap_score", sql(
    LI_ALLOC, "SELECT * FROM overlap",
    "d:as_of_date ticker company_name sector i:market_cap f:return_20 f:score is_new source_periods"))
def period_overlap_score(spark, sf_dir):
    return portfolio.period_overlap(line_stock_allocation(spark, sf_dir)).select(
        "as_of_date", "ticker", "company_name", "sector", "market_cap", "return_20", "score", "is_new",
        "source_periods",
    )


@query("allocate_perf_inv_mcap", sql(
    LI_ALLOC, "SELECT * FROM stock_alloc",
    "d:as_of_date i:period_days ticker company_name sector i:market_cap f:return_pct f:portfolio_weight "
    "allocation_reason i:fund_count i:rank"))
def allocate_perf_inv_mcap(spark, sf_dir):
    return portfolio.roll_up_by_stock(line_allocation(spark, sf_dir, ranked=True))


_PIVOT = ", ".join(f"arg_max(price, seq) FILTER (fund = '{f}') AS {f}" for f in EVENT_FUNDS)


@query("pivot_close", sql(
    EV, f"SELECT d AS trade_date, {_PIVOT} FROM ev GROUP BY d",
    "d:trade_date " + " ".join(f"f:{f}" for f in EVENT_FUNDS)))
def pivot_close(spark, sf_dir):
    ticks = event_ticks(spark, sf_dir).select("trade_date", F.col("fund").alias("ticker"), "price", "seq")
    return boards.pivot_close(ticks, boards.column_tickers(event_market(spark, sf_dir).fund_meta))


@query("sector_sum_change", sql(EV, f"""
SELECT sector, sum(price_change_percent) AS cum_return,
  (SELECT sum(price_change_percent) FROM fund_prices WHERE ticker = 'view' AND trade_date >= {AS_OF} - 13)
    AS benchmark_cum_return
FROM stock_prices WHERE trade_date >= {AS_OF} - 13 GROUP BY sector ORDER BY cum_return DESC, sector LIMIT 10""",
    "sector f:cum_return f:benchmark_cum_return"))
def sector_sum_change(spark, sf_dir):
    m = event_market(spark, sf_dir)
    return boards.sector_change_sums(m.stored_stock_prices, m.stored_fund_prices, m.benchmark, m.stored_clock, 10)


_MONTH_START = f"CAST(date_trunc('month', {AS_OF}) AS DATE)"


@query("mtd_top_equal_weight", sql(LI, f"""
SELECT ticker, company_name, sector, avg(price_change_percent) AS avg_change FROM stock_prices
WHERE trade_date >= {_MONTH_START} AND ticker <> 'SPY' AND sector <> 'Benchmark'
GROUP BY ticker, company_name, sector ORDER BY avg_change DESC, ticker LIMIT 10""",
    "ticker company_name sector f:avg_change"))
def mtd_top_equal_weight(spark, sf_dir):
    m = line_market(spark, sf_dir)
    return boards.mtd_top_equal_weight(m.stored_stock_prices, m.stored_clock)


def _leaders_sql(scope: str, condition: str) -> str:
    return f"""
  SELECT '{scope}' AS scope, year({AS_OF}) AS year, month({AS_OF}) AS month, ticker, company_name, sector,
    avg_change AS avg_monthly_return, true AS is_trending
  FROM (SELECT ticker, company_name, sector, avg(price_change_percent) AS avg_change FROM stock_prices
    WHERE {condition} GROUP BY 1, 2, 3) t
  WHERE sector IN (
    SELECT sector FROM (SELECT sector, avg(price_change_percent) AS a FROM stock_prices WHERE {condition} GROUP BY 1) s
    WHERE a > 0 OR NOT EXISTS (
      SELECT 1 FROM stock_prices WHERE {condition} GROUP BY sector HAVING avg(price_change_percent) > 0)
    ORDER BY a DESC, sector LIMIT 10)
  QUALIFY row_number() OVER (PARTITION BY sector ORDER BY avg_change DESC, ticker) = 1"""


@query("sector_leader_mtd", sql(
    LI, f"({_leaders_sql('mtd', f'trade_date >= {_MONTH_START}')}) UNION ALL ({_leaders_sql('htd', 'true')})",
    "scope i:year i:month ticker company_name sector f:avg_monthly_return is_trending"))
def sector_leader_mtd(spark, sf_dir):
    m = line_market(spark, sf_dir)
    month = boards.sector_leaders(m.stored_stock_prices, m.stored_clock).withColumn("scope", F.lit("mtd"))
    history = boards.sector_leaders(m.stored_stock_prices, m.stored_clock, only_month=False).withColumn("scope", F.lit("htd"))
    return month.unionByName(history)


def _board_sql(p: int) -> str:
    window = f"trade_date >= {AS_OF} - {p + 3}"
    return f"""
funds_{p} AS (
  SELECT ticker, CASE WHEN day_count >= 2 THEN return_pct ELSE 0e0 END AS gain
  FROM ({point_returns_sql(f'(SELECT * FROM fund_prices WHERE {window}) w')}) g),
gains_{p} AS (
  SELECT ticker, company_name, sector, return_pct AS period_return
  FROM ({point_returns_sql(f'(SELECT * FROM stock_prices WHERE {window}) w', 'ticker, company_name, sector')}) g
  WHERE day_count >= 2 AND end_price > 0),
sectors_{p} AS (
  SELECT *, row_number() OVER (ORDER BY avg_return DESC, sector) AS sector_rank FROM (
    SELECT s.sector, count(*) AS stock_count, COALESCE(max(gain), avg(period_return)) AS avg_return
    FROM gains_{p} s LEFT JOIN fund_meta m ON m.sector_name = s.sector LEFT JOIN funds_{p} f ON f.ticker = m.ticker
    GROUP BY s.sector) a
  WHERE avg_return > 0 AND avg_return > COALESCE((SELECT gain FROM funds_{p} WHERE ticker = 'view'), 0)
  QUALIFY sector_rank <= 10),
ranked_{p} AS (
  SELECT g.*, sector_rank, row_number() OVER (PARTITION BY g.sector ORDER BY period_return DESC, ticker) AS stock_rank
  FROM gains_{p} g JOIN sectors_{p} s ON s.sector = g.sector),"""


def _board_rows(p: int) -> str:
    return f"""
SELECT 'sector' AS section, {p} AS period_days, sector_rank, 0 AS stock_rank, sector, CAST(stock_count AS VARCHAR) AS item,
  avg_return AS value FROM sectors_{p}
UNION ALL
SELECT 'leader', {p}, sector_rank, stock_rank, sector, ticker, period_return FROM ranked_{p} WHERE stock_rank = 1
UNION ALL
SELECT 'detail', {p}, sector_rank, stock_rank, sector, ticker, period_return FROM ranked_{p}
WHERE stock_rank <= 5 AND sector_rank <= 5"""


@query("period_trend_board", sql(
    EV + "".join(_board_sql(p) for p in (5, 10, 20)), " UNION ALL ".join(_board_rows(p) for p in (5, 10, 20)),
    "section i:period_days i:sector_rank i:stock_rank sector item f:value"))
def period_trend_board(spark, sf_dir):
    m = event_market(spark, sf_dir)
    sectors = m.stored_fund_meta.filter(F.col("sector_name").isNotNull()).select(
        "ticker", F.col("sector_name").alias("sector")
    )
    board = boards.period_trend_board(m.stored_stock_prices, m.stored_fund_prices, sectors, m.benchmark, m.stored_clock)
    columns = ["section", "period_days", "sector_rank", "stock_rank", "sector", "item", "value"]
    top = board.sectors.withColumns({
        "section": F.lit("sector"), "stock_rank": F.lit(0), "item": F.col("stock_count").cast("string"),
        "value": F.col("avg_return"),
    }).select(*columns)

    def stocks(frame, name):
        return frame.withColumns(
            {"section": F.lit(name), "item": F.col("ticker"), "value": F.col("period_return")}
        ).select(*columns)

    return top.unionByName(stocks(board.leaders, "leader")).unionByName(stocks(board.details, "detail"))


@query("string_agg_by_type", sql(
    EV, "SELECT etf_type, count(*) AS fund_count, string_agg(ticker, ', ' ORDER BY ticker) AS tickers FROM fund_meta GROUP BY 1",
    "etf_type i:fund_count tickers"))
def string_agg_by_type(spark, sf_dir):
    return boards.funds_by_type(event_market(spark, sf_dir).fund_meta)


@query("tick_to_bar", sql(
    EV, "SELECT * FROM stock_bars",
    "ticker sector d:trade_date f:open_price f:high_price f:low_price f:close_price i:volume"))
def tick_to_bar(spark, sf_dir):
    return returns.bars_from_ticks(event_ticks(spark, sf_dir), ("ticker", "sector"))
