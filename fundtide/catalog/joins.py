"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundtide.catalog.base import (
    AS_OF, EV, EV_TOP, LI, LI_ALLOC, LI_TREND, event_top_holdings, latest_sql, line_stock_allocation, line_trending,
    period_returns_sql, point_returns_sql, query, sql,
)
from fundtide.catalog.plans import LI_BOARD, PRIORITY, _PRIORITY_SQL, line_board
from fundtide.operators import joins, portfolio, returns
from fundtide.operators.windows import latest_per_key, since
from fundtide.sources import tables
from fundtide.sources.market import event_market, line_market, load
from fundtide.sources.workspace import materialized


@query("prices_with_meta", sql(
    LI, "SELECT f.*, etf_type, sector_name FROM fund_prices f LEFT JOIN fund_meta m ON m.ticker = f.ticker",
    "ticker d:trade_date f:close_price etf_type sector_name"))
def prices_with_meta(spark, sf_dir):
    m = line_market(spark, sf_dir)
    return joins.prices_with_meta(m.fund_prices, m.fund_meta).select(
        "ticker", "trade_date", "close_price", "etf_type", "sector_name"
    )


_STOCK_RETURNS = LI + f"stock_returns AS ({period_returns_sql('stock_prices')}),"


@query("returns_with_holdings", sql(_STOCK_RETURNS, f"""
SELECT r.ticker, period_days, return_pct, etf_ticker FROM stock_returns r
JOIN (SELECT DISTINCT etf_ticker, holding_ticker FROM holdings WHERE as_of_date >= {AS_OF} - 365) h
  ON h.holding_ticker = r.ticker""", "ticker i:period_days f:return_pct etf_ticker"))
def returns_with_holdings(spark, sf_dir):
    m = line_market(spark, sf_dir)
    gains = returns.period_returns(m.stock_prices).select("ticker", "period_days", "return_pct")
    return joins.returns_with_holdings(gains, tables.scan_recent_holdings(m.positions, m.clock, 365))


@query("join_latest_metadata", sql(_STOCK_RETURNS + f"newest AS ({latest_sql('stock_prices', 'ticker', 'trade_date')}),", """
SELECT r.ticker, period_days, return_pct, company_name, sector, market_cap FROM stock_returns r
JOIN newest n ON n.ticker = r.ticker AND market_cap > 0""",
    "ticker i:period_days f:return_pct company_name sector i:market_cap"))
def join_latest_metadata(spark, sf_dir):
    return joins.join_latest_metadata(line_market(spark, sf_dir).stock_prices, require_market_cap=True)


_SECTOR_TREND = EV + f"""
fund_gains AS ({period_returns_sql('fund_prices')}),
sector_trend AS (
  SELECT {AS_OF} AS as_of_date, sector_name AS sector, return_pct, b.benchmark_return, f.period_days,
    return_pct > b.benchmark_return AND return_pct > 0 AS is_trending
  FROM fund_gains f JOIN fund_meta m ON m.ticker = f.ticker AND sector_name IS NOT NULL
  JOIN (SELECT period_days, return_pct AS benchmark_return FROM fund_gains WHERE ticker = 'view') b
    ON b.period_days = f.period_days),
stock_gains AS ({period_returns_sql('stock_prices')}),
newest AS ({latest_sql('stock_prices', 'ticker', 'trade_date')}),
in_sector AS (
  SELECT g.ticker, company_name, n.sector, market_cap, g.period_days, g.return_pct, t.return_pct AS sector_avg
  FROM stock_gains g JOIN newest n ON n.ticker = g.ticker
  JOIN sector_trend t ON t.sector = n.sector AND t.period_days = g.period_days AND t.is_trending),
"""


def event_sector_trend(spark, sf_dir):
    m = event_market(spark, sf_dir)
    # The benchmark's row and the funds' rows both come from these few rows.
    gains = materialized(returns.period_returns(m.fund_prices), "fund-returns")
    sectors = m.fund_meta.filter(F.col("sector_name").isNotNull()).select(
        "ticker", F.col("sector_name").alias("sector")
    )
    return portfolio.sector_trending(gains, sectors, m.benchmark, m.clock)


def event_stocks_in_sectors(spark, sf_dir):
    stocks = event_market(spark, sf_dir).stock_prices
    # The newest row's attributes come with the returns, so the bars are read once.
    gains = returns.period_returns(stocks, carry=["company_name", "sector", "market_cap"]).select(
        "ticker", "period_days", "return_pct", "company_name", "sector", "market_cap")
    return joins.stocks_in_trending_sectors(gains, event_sector_trend(spark, sf_dir))


@query("stocks_in_trending_sectors", sql(
    _SECTOR_TREND, "SELECT * FROM in_sector",
    "ticker company_name sector i:market_cap i:period_days f:return_pct f:sector_avg"))
def stocks_in_trending_sectors(spark, sf_dir):
    return event_stocks_in_sectors(spark, sf_dir)


@query("sector_trending", sql(
    _SECTOR_TREND, f"SELECT *, year({AS_OF}) AS year, month({AS_OF}) AS month FROM sector_trend",
    "d:as_of_date i:year i:month sector f:return_pct f:benchmark_return i:period_days is_trending"))
def sector_trending(spark, sf_dir):
    return event_sector_trend(spark, sf_dir)


@query("stock_vs_sector", sql(_SECTOR_TREND, f"""
SELECT *, {AS_OF} AS as_of_date, year({AS_OF}) AS year, month({AS_OF}) AS month,
  return_pct - sector_avg AS vs_sector, return_pct > sector_avg AS is_trending FROM in_sector""",
    "d:as_of_date i:year i:month ticker company_name sector i:market_cap f:return_pct f:sector_avg i:period_days "
    "f:vs_sector is_trending"))
def stock_vs_sector(spark, sf_dir):
    return portfolio.stock_vs_sector(
        event_stocks_in_sectors(spark, sf_dir), event_market(spark, sf_dir).clock
    )


@query("holdings_meta_metrics", sql(
    EV_TOP, "SELECT * FROM combined",
    "etf_ticker etf_type sector_name holding_ticker f:holding_percent i:period_days f:avg_return f:total_return "
    "f:volatility i:trading_days"))
def holdings_meta_metrics(spark, sf_dir):
    m = event_market(spark, sf_dir)
    pairs = latest_per_key(m.holdings, ["etf_ticker", "holding_ticker"], "as_of_date")
    metrics = returns.stock_metrics(m.stored_stock_prices, m.stored_clock)
    return joins.holdings_meta_metrics(pairs, m.held_fund_meta, metrics).select(
        "etf_ticker", "etf_type", "sector_name", "holding_ticker", "holding_percent", "period_days", "avg_return",
        "total_return", "volatility", "trading_days",
    )


@query("left_join_periods", sql(LI_ALLOC, """
SELECT a.as_of_date, a.ticker, a.portfolio_weight AS weight_20, b.portfolio_weight AS weight_10,
  c.portfolio_weight AS weight_5
FROM stock_alloc a
LEFT JOIN stock_alloc b ON b.ticker = a.ticker AND b.period_days = 10
LEFT JOIN stock_alloc c ON c.ticker = a.ticker AND c.period_days = 5
WHERE a.period_days = 20""", "d:as_of_date ticker f:weight_20 f:weight_10 f:weight_5"))
def left_join_periods(spark, sf_dir):
    return joins.left_join_periods(line_stock_allocation(spark, sf_dir))


@query("anti_join_new", sql(LI_ALLOC, """
SELECT * FROM stock_alloc WHERE period_days <> 20
  AND ticker NOT IN (SELECT ticker FROM stock_alloc WHERE period_days = 20)""",
    "d:as_of_date i:period_days ticker f:portfolio_weight"))
def anti_join_new(spark, sf_dir):
    return joins.anti_join_new(line_stock_allocation(spark, sf_dir)).select(
        "as_of_date", "period_days", "ticker", "portfolio_weight"
    )


@query("scalar_cross_join", sql(EV + f"""
recent AS (SELECT * FROM fund_prices WHERE trade_date BETWEEN {AS_OF} - 20 AND {AS_OF}),
gains AS ({point_returns_sql('recent')}),
""", "SELECT r.*, (SELECT return_pct FROM gains WHERE ticker = 'view') AS benchmark_return FROM recent r",
    "ticker d:trade_date f:close_price f:benchmark_return"))
def scalar_cross_join(spark, sf_dir):
    m = event_market(spark, sf_dir)
    start, end = m.as_of(20), m.as_of()
    gains = returns.point_return(m.fund_prices.filter(F.col("trade_date").between(start, end)))
    reference = gains.filter(F.col("ticker") == m.benchmark).agg(F.max("return_pct").alias("r")).scalar()
    return joins.within_scalar_range(m.fund_prices, start, end, reference).select(
        "ticker", "trade_date", "close_price", "benchmark_return"
    )


@query("self_join_first_last", sql(LI + f"gains AS ({point_returns_sql('stock_prices')}),", "SELECT * FROM gains",
    "ticker d:start_date f:start_price d:end_date f:end_price f:return_pct"))
def self_join_first_last(spark, sf_dir):
    return joins.first_last(line_market(spark, sf_dir).stock_prices)


_SNAPSHOT = "SELECT * FROM holdings QUALIFY rank() OVER (PARTITION BY etf_ticker ORDER BY as_of_date DESC) = 1"


@query("latest_snapshot_join", sql(
    LI, _SNAPSHOT, "etf_ticker holding_ticker holding_name f:holding_percent i:holding_shares f:holding_value "
    "d:as_of_date"))
def latest_snapshot_join(spark, sf_dir):
    return line_market(spark, sf_dir).snapshot.drop("source", "arrival")


@query("holdings_left_mcap_returns", sql(EV + f"""
snapshot AS ({_SNAPSHOT}),
recent AS (SELECT * FROM stock_prices WHERE trade_date >= {AS_OF} - 20),
caps AS ({latest_sql('recent', 'ticker', 'trade_date')}),
gains AS ({point_returns_sql('recent')}),
""", """SELECT etf_ticker, holding_ticker, COALESCE(holding_name, company_name) AS holding_name, market_cap,
  COALESCE(CAST(trade_date AS VARCHAR), 'none') AS trade_date, return_pct AS holding_return_pct
FROM snapshot LEFT JOIN caps ON caps.ticker = holding_ticker LEFT JOIN gains ON gains.ticker = holding_ticker""",
    "etf_ticker holding_ticker holding_name f:market_cap trade_date f:holding_return_pct"))
def holdings_left_mcap_returns(spark, sf_dir):
    m = event_market(spark, sf_dir)
    out = joins.holdings_left_mcap_returns(
        m.snapshot, returns.latest_and_return(since(m.stored_stock_prices, m.stored_clock, 20)))
    return out.select(
        "etf_ticker", "holding_ticker", "holding_name", F.col("market_cap").cast("double").alias("market_cap"),
        F.coalesce(F.col("trade_date").cast("string"), F.lit("none")).alias("trade_date"), "holding_return_pct",
    )


@query("holding_across_funds", sql(
    EV_TOP, "SELECT * FROM top_holdings",
    "holding_ticker i:time_period etf_ticker etf_type sector_name i:rank_position f:total_return f:volatility "
    "d:as_of_date"))
def holding_across_funds(spark, sf_dir):
    return joins.holding_across_funds(event_top_holdings(spark, sf_dir, stored=True))


TRENDING_COVERAGE = LI_TREND + f"""
live AS (SELECT DISTINCT etf_ticker FROM trend WHERE is_trending),
coverage AS (
  SELECT (SELECT count(*) FROM live) AS trending_count,
    (SELECT count(DISTINCT holding_ticker) FROM holdings h JOIN live USING (etf_ticker)
      WHERE h.as_of_date >= {AS_OF} - 40) AS holdings_count,
    (SELECT count(DISTINCT s.ticker) FROM stock_prices s JOIN holdings h ON h.holding_ticker = s.ticker
      JOIN live ON live.etf_ticker = h.etf_ticker WHERE s.trade_date >= {AS_OF} - 25) AS stock_count),
"""


def line_coverage(spark, sf_dir):
    m = line_market(spark, sf_dir)
    return joins.trending_coverage(
        line_trending(spark, sf_dir, described=False), m.positions, m.stored_stock_prices, m.stored_clock, holding_days=40
    )


@query("trending_coverage_join", sql(
    TRENDING_COVERAGE, "SELECT * FROM coverage", "i:trending_count i:holdings_count i:stock_count"))
def trending_coverage_join(spark, sf_dir):
    return line_coverage(spark, sf_dir)


@query("coalesce_two_sources", """
WITH a AS (
  SELECT * FROM (
    SELECT CAST(l_partkey AS VARCHAR) AS ticker, CASE WHEN p_size >= 10 THEN p_type END AS sector, p_name AS name
    FROM (SELECT DISTINCT l_partkey FROM lineitem) l JOIN part ON p_partkey = l_partkey) s WHERE sector IS NOT NULL),
b AS (
  SELECT CAST(o_custkey AS VARCHAR) AS ticker, c_mktsegment AS sector, c_name AS name
  FROM (SELECT DISTINCT o_custkey FROM orders) o JOIN customer ON c_custkey = o_custkey)
SELECT COALESCE(a.ticker, b.ticker) AS ticker, COALESCE(a.sector, b.sector) AS sector,
  CASE WHEN a.ticker IS NULL THEN b.name ELSE a.name END AS company_name
FROM a FULL OUTER JOIN b ON a.ticker = b.ticker""")
def coalesce_two_sources(spark, sf_dir):
    part, customer = load(spark, sf_dir, "part"), load(spark, sf_dir, "customer")
    shipped = load(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.max("l_shipdate").alias("seen"))
    primary = shipped.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_partkey").cast("string").alias("ticker"), "seen",
        F.when(F.col("p_size") >= 10, F.col("p_type")).alias("sector"), F.col("p_name").alias("company_name"),
    )
    secondary = load(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").cast("string").alias("ticker"), F.col("o_orderdate").alias("seen"),
        F.col("c_mktsegment").alias("sector"), F.col("c_name").alias("company_name"),
    )
    return joins.coalesce_two_sources(primary, secondary)


@query("pick_source_fund", sql(LI_BOARD + f"""
offers AS (
  SELECT b.holding_ticker, b.etf_ticker AS offered_by FROM board b WHERE is_benchmark
  QUALIFY row_number() OVER (PARTITION BY b.holding_ticker ORDER BY {_PRIORITY_SQL}, b.etf_ticker) = 1),
""", """SELECT b.etf_ticker, b.holding_ticker, holding_return_pct, COALESCE(offered_by, b.etf_ticker) AS source_etf,
  CASE WHEN offered_by IS NULL THEN 'trending' ELSE 'benchmark' END AS source_type
FROM board b LEFT JOIN offers o ON o.holding_ticker = b.holding_ticker
WHERE is_trending AND holding_return_pct IS NOT NULL""",
    "etf_ticker holding_ticker f:holding_return_pct source_etf source_type"))
def pick_source_fund(spark, sf_dir):
    board = materialized(line_board(spark, sf_dir), "board")
    picks = board.filter(F.col("is_trending") & F.col("holding_return_pct").isNotNull())
    return joins.pick_source_fund(picks, board.filter("is_benchmark"), PRIORITY).select(
        "etf_ticker", "holding_ticker", "holding_return_pct", "source_etf", "source_type"
    )
