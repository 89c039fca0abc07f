"""Data-quality gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundtide.catalog.base import (
    AS_OF, EV, EV_TOP, LI, LI_ALLOC, LI_TREND, event_top_holdings, line_stock_allocation,
    line_trending, query, sql,
)
from fundtide.catalog.joins import TRENDING_COVERAGE, line_coverage
from fundtide.operators import quality
from fundtide.sources.market import event_market, line_market, load

_RULE_COLUMNS = "rule f:observed f:required passed"


def _rules_sql(*rules: tuple[str, str, str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, {seen} AS observed, {need} AS required, {seen} {op} {need} AS passed FROM figures"
        for name, seen, op, need in rules
    )


@query("gate_price_ready", sql(LI + f"""
figures AS (
  SELECT (SELECT count(DISTINCT ticker) FROM fund_prices WHERE trade_date >= {AS_OF} - 2) AS funds,
    (SELECT count(*) FROM fund_prices WHERE ticker = '0' AND trade_date >= {AS_OF} - 25) AS bench),
""", _rules_sql(("funds_with_recent_bars", "funds", ">=", "15"), ("benchmark_rows", "bench", ">=", "15")),
    _RULE_COLUMNS))
def gate_price_ready(spark, sf_dir):
    m = line_market(spark, sf_dir, last_days=25)
    return quality.gate_price_ready(m.fund_prices, m.benchmark, m.clock)


@query("gate_allocation_ready", sql(
    TRENDING_COVERAGE + "figures AS (SELECT * FROM coverage),",
    """SELECT 'trending_funds' AS rule, trending_count AS observed, 1 AS required, trending_count > 0 AS passed FROM figures
UNION ALL """ + _rules_sql(
        ("holdings_tracked", "holdings_count", ">=", "trending_count"),
        ("stocks_with_history", "stock_count", ">=", "trending_count")),
    _RULE_COLUMNS))
def gate_allocation_ready(spark, sf_dir):
    return quality.gate_allocation_ready(line_coverage(spark, sf_dir))


@query("gate_history_ready", sql(EV + f"""
figures AS (
  SELECT count(DISTINCT ticker) AS tickers, count(DISTINCT trade_date) AS days,
    (SELECT count(*) FROM fund_meta) AS funds, (SELECT count(*) FROM holdings) AS positions
  FROM stock_prices WHERE trade_date >= {AS_OF} - 40),
""", _rules_sql(
    ("stock_tickers", "tickers", ">=", "1"), ("history_days", "days", ">=", "20"), ("funds", "funds", ">=", "1"),
    ("holdings", "positions", ">=", "1")), _RULE_COLUMNS))
def gate_history_ready(spark, sf_dir):
    m = event_market(spark, sf_dir)
    return quality.gate_history_ready(m.stored_fund_meta, m.stored_stock_prices, m.positions, m.stored_clock)


@query("verify_results", sql(EV_TOP, """
SELECT 'period' AS grouping_name, CAST(time_period AS VARCHAR) AS item, count(*) AS record_count,
  count(DISTINCT etf_ticker) AS etf_count, max(as_of_date) AS latest_date FROM top_holdings GROUP BY 2
UNION ALL
SELECT 'type', etf_type, count(*), count(DISTINCT etf_ticker), max(as_of_date) FROM top_holdings GROUP BY 2
UNION ALL
SELECT 'missing period', CAST(p AS VARCHAR), 0, 0, NULL FROM (VALUES (5), (10), (20), (40)) v(p)
WHERE p NOT IN (SELECT time_period FROM top_holdings)""",
    "grouping_name item i:record_count i:etf_count d:latest_date").replace(
        "CAST(CAST(latest_date AS DATE) AS VARCHAR)", "COALESCE(CAST(CAST(latest_date AS DATE) AS VARCHAR), 'none')"))
def verify_results(spark, sf_dir):
    top = event_top_holdings(spark, sf_dir, stored=True)
    zero = F.lit(0).cast("bigint")

    def shaped(frame, name, item):
        return frame.select(
            F.lit(name).alias("grouping_name"), F.col(item).cast("string").alias("item"), "record_count", "etf_count",
            F.coalesce(F.col("latest_date").cast("string"), F.lit("none")).alias("latest_date"),
        )

    missing = quality.missing_periods(top, (5, 10, 20, 40)).withColumns(
        {"record_count": zero, "etf_count": zero, "latest_date": F.lit(None).cast("date")}
    )
    return (
        shaped(quality.result_counts(top), "period", "time_period")
        .unionByName(shaped(quality.result_counts(top, "etf_type"), "type", "etf_type"))
        .unionByName(shaped(missing, "missing period", "time_period"))
    )


@query("verify_trending", sql(LI_TREND, """
SELECT as_of_date, period_days, count(*) AS total_etfs, count(*) FILTER (is_trending) AS trending_count
FROM trend GROUP BY 1, 2""", "d:as_of_date i:period_days i:total_etfs i:trending_count"))
def verify_trending(spark, sf_dir):
    return quality.trending_counts(line_trending(spark, sf_dir, described=False))


@query("verify_collection", sql(LI_TREND, f"""
SELECT count(DISTINCT etf_ticker) AS etf_count, count(DISTINCT holding_ticker) AS holding_count,
  (SELECT count(DISTINCT ticker) FROM stock_prices WHERE trade_date >= {AS_OF} - 1) AS stock_count,
  (SELECT count(*) FROM trend WHERE is_trending) AS trending_count
FROM holdings WHERE as_of_date = (SELECT max(as_of_date) FROM holdings)""",
    "i:etf_count i:holding_count i:stock_count i:trending_count"))
def verify_collection(spark, sf_dir):
    m = line_market(spark, sf_dir)
    newest = m.positions.agg(F.max("as_of_date").alias("d")).scalar()
    return quality.collected_counts(
        line_trending(spark, sf_dir, described=False), m.positions, m.stock_prices, m.clock, newest
    )


@query("verify_weights", sql(LI_ALLOC, """
SELECT 'period ' || CAST(period_days AS VARCHAR) AS portfolio, count(*) AS stock_count,
  sum(portfolio_weight) AS total_weight, abs(sum(portfolio_weight) - 1) <= 0.01 AS weight_ok, true AS size_ok
FROM stock_alloc GROUP BY period_days
UNION ALL
SELECT 'monthly', count(*), sum(final_weight), abs(sum(final_weight) - 1) <= 0.01, count(*) <= 20 FROM monthly
GROUP BY rebalance_date""", "portfolio i:stock_count f:total_weight weight_ok size_ok"))
def verify_weights(spark, sf_dir):
    from fundtide.plans.jobs import monthly_rebalance

    alloc = line_stock_allocation(spark, sf_dir)
    by_period = quality.verify_weights(alloc, ["as_of_date", "period_days"], "portfolio_weight").withColumn(
        "portfolio", F.concat(F.lit("period "), F.col("period_days").cast("string"))
    )
    monthly = quality.verify_weights(monthly_rebalance(alloc), ["rebalance_date"], "final_weight", 20).withColumn(
        "portfolio", F.lit("monthly")
    )
    columns = ["portfolio", "stock_count", "total_weight", "weight_ok", "size_ok"]
    return by_period.select(*columns).unionByName(monthly.select(*columns))


@query("duplicate_keys", """
SELECT l_partkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS trade_date, count(*) AS copies
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select("l_partkey", F.to_date("l_shipdate").alias("trade_date"))
    return quality.duplicate_keys(lines, ["l_partkey", "trade_date"])


@query("bounds_checks", sql(LI + """
figures AS (
  SELECT count(*) FILTER (price_change_percent <= -100 OR price_change_percent >= 500) AS returns,
    count(*) FILTER (volume <= 0) AS volumes, count(*) FILTER (close_price <= 0 OR close_price >= 1000000) AS prices,
    (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS stamps
  FROM fund_prices),
""", _rules_sql(
    ("return_within_bounds", "returns", "=", "0"), ("volume_positive", "volumes", "=", "0"),
    ("price_within_bounds", "prices", "=", "0"), ("timestamp_readable", "stamps", "=", "0")), _RULE_COLUMNS))
def bounds_checks(spark, sf_dir):
    # Orders in process stand for messages whose time cannot be read.
    stamps = load(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "P", F.concat_ws(" ", F.lit("at"), "o_orderpriority"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("raw_timestamp")
    )
    return quality.bounds_checks(line_market(spark, sf_dir).fund_prices, stamps)


@query("inventory_report", sql(EV, """
SELECT 'stock' AS kind, ticker, count(*) AS row_count, min(trade_date) AS min_date, max(trade_date) AS max_date
FROM stock_prices GROUP BY ticker
UNION ALL
SELECT 'fund', ticker, count(*), min(trade_date), max(trade_date) FROM fund_prices GROUP BY ticker""",
    "kind ticker i:row_count d:min_date d:max_date"))
def inventory_report(spark, sf_dir):
    m = event_market(spark, sf_dir)
    stocks = quality.inventory(m.stock_prices, ["ticker"], "trade_date").withColumn("kind", F.lit("stock"))
    funds = quality.inventory(m.fund_prices, ["ticker"], "trade_date").withColumn("kind", F.lit("fund"))
    return stocks.unionByName(funds)


@query("collection_success_rate", sql(LI, f"""
SELECT count(*) AS expected_count, count(f.ticker) AS success_count, count(*) - count(f.ticker) AS failed_count,
  count(f.ticker) / CAST(count(*) AS DOUBLE) * 100e0 AS success_rate,
  1 - count(f.ticker) / CAST(count(*) AS DOUBLE) > 0.7 AS too_many_failures,
  count(f.ticker) / CAST(count(*) AS DOUBLE) < 0.5 AS below_success_floor
FROM fund_meta m LEFT JOIN (SELECT DISTINCT ticker FROM fund_prices WHERE trade_date >= {AS_OF} - 2) f
  ON f.ticker = m.ticker""",
    "i:expected_count i:success_count i:failed_count f:success_rate too_many_failures below_success_floor"))
def collection_success_rate(spark, sf_dir):
    m = line_market(spark, sf_dir, last_days=2)
    return quality.collection_success(m.fund_meta, m.fund_prices)
