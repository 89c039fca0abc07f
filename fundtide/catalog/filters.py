"""Filters, projections and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundtide.catalog.base import (
    AS_OF, EV, EV_TOP, LI, LI_TREND, event_top_holdings, line_trending, period_returns_sql, point_returns_sql,
    query, sql,
)
from fundtide.functions import columns as C
from fundtide.operators import boards, filters, portfolio, returns
from fundtide.sources.market import EVENT_FUND_SECTORS, event_market, line_market, load
from fundtide.sources.workspace import materialized


@query("filter_trailing_days", sql(
    EV, f"SELECT * FROM stock_prices WHERE trade_date >= {AS_OF} - 7",
    "ticker company_name sector d:trade_date f:close_price f:price_change_percent i:volume i:market_cap"))
def filter_trailing_days(spark, sf_dir):
    m = event_market(spark, sf_dir)
    return filters.trailing_days(m.stored_stock_prices, m.stored_clock, 7).select(
        "ticker", "company_name", "sector", "trade_date", "close_price", "price_change_percent", "volume", "market_cap"
    )


@query("filter_date_range", sql(EV, f"""
SELECT ticker AS symbol, sector, close_price AS avg_price, volume AS total_volume, low_price AS min_price,
  high_price AS max_price, 1 AS record_count, trade_date AS window_start, trade_date AS window_end
FROM stock_prices WHERE trade_date BETWEEN {AS_OF} - 20 AND {AS_OF} - 3
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) <= 5""",
    "symbol sector f:avg_price i:total_volume f:min_price f:max_price i:record_count d:window_start d:window_end"))
def filter_date_range(spark, sf_dir):
    m = event_market(spark, sf_dir)
    return filters.price_history(m.stock_prices, m.as_of(20), m.as_of(3), limit=5)


@query("filter_valid_instruments", """
SELECT p_partkey, ticker, name FROM (
  SELECT p_partkey, p_name AS name,
    CASE WHEN p_size > 25 THEN 'Stock' || CAST(p_partkey AS VARCHAR) ELSE p_name END AS ticker FROM part) listed
WHERE NOT regexp_matches(upper(ticker), '^STOCK[0-9]+$') AND NOT starts_with(upper(name), 'STOCK ')
  AND NOT starts_with(upper(name), 'SMALL ')
""")
def filter_valid_instruments(spark, sf_dir):
    listed = load(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("name"),
        F.when(F.col("p_size") > 25, F.concat(F.lit("Stock"), F.col("p_partkey").cast("string")))
        .otherwise(F.col("p_name")).alias("ticker"),
    )
    return filters.valid_instruments(listed, "ticker", "name", prefixes=("STOCK ", "SMALL "))


_LISTED_SQL = """
SELECT c_custkey, c_name AS ticker, CASE WHEN c_nationkey < 5 THEN NULL ELSE c_name END AS company_name,
  CASE WHEN c_acctbal < 0 THEN 'Unknown' WHEN c_nationkey = 7 THEN NULL ELSE c_mktsegment END AS sector,
  CASE WHEN c_nationkey = 3 THEN NULL ELSE c_custkey * 1000 END AS market_cap
FROM customer"""


def _listed(spark, sf_dir):
    nation = F.col("c_nationkey")
    return load(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("ticker"),
        F.when(nation >= 5, F.col("c_name")).alias("company_name"),
        F.when(F.col("c_acctbal") < 0, "Unknown").when(nation != 7, F.col("c_mktsegment")).alias("sector"),
        F.when(nation != 3, F.col("c_custkey") * 1000).alias("market_cap"),
    )


@query("filter_known_sector", f"""
SELECT c_custkey, ticker, sector FROM ({_LISTED_SQL}) listed WHERE sector IS NOT NULL AND sector <> 'Unknown'""")
def filter_known_sector(spark, sf_dir):
    return filters.known_sector(_listed(spark, sf_dir)).select("c_custkey", "ticker", "sector")


@query("filter_min_coverage", sql(LI, f"""
SELECT ticker, p AS period_days, count(*) AS day_count FROM fund_prices
JOIN (VALUES (5), (10), (20)) period(p) ON trade_date >= {AS_OF} - (p + 20)
GROUP BY ticker, p HAVING count(*) >= p * 0.7""", "ticker i:period_days i:day_count"))
def filter_min_coverage(spark, sf_dir):
    m = line_market(spark, sf_dir, last_days=40)
    windows = returns.calendar_periods(m.fund_prices.select("ticker", "trade_date"), m.clock, (5, 10, 20), 20)
    return filters.min_coverage(windows.groupBy("ticker", "period_days").agg(F.count("*").alias("day_count")))


@query("filter_in_set", sql(
    LI_TREND, "SELECT * FROM holdings WHERE etf_ticker IN (SELECT etf_ticker FROM trend WHERE is_trending)",
    "etf_ticker holding_ticker d:as_of_date i:holding_shares f:holding_percent"))
def filter_in_set(spark, sf_dir):
    trending = line_trending(spark, sf_dir, described=False).filter("is_trending")
    return filters.in_set(line_market(spark, sf_dir).holdings, trending, "etf_ticker").select(
        "etf_ticker", "holding_ticker", "as_of_date", "holding_shares", "holding_percent"
    )


@query("allowed_universe", sql(
    EV, "SELECT * FROM fund_prices WHERE ticker IN ('view', 'click', 'purchase')",
    "ticker d:trade_date f:close_price i:volume"))
def allowed_universe(spark, sf_dir):
    prices = event_market(spark, sf_dir).fund_prices
    return filters.allowed_universe(prices, ("view", "click", "purchase")).select(
        "ticker", "trade_date", "close_price", "volume"
    )


@query("filter_non_null", """
SELECT event_id, ticker, floor(price * 1e6 + 5e-1) / 1e6 AS price FROM (
  SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS ticker,
    CASE WHEN event_type <> 'signup' THEN value END AS price FROM events) ticks
WHERE ticker IS NOT NULL AND price IS NOT NULL""")
def filter_non_null(spark, sf_dir):
    ticks = load(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("ticker"),
        F.when(F.col("event_type") != "signup", F.col("value")).alias("price"),
    )
    return filters.non_null(ticks, ["ticker", "price"])


@query("project_map_lookup", sql(EV, """
SELECT f.ticker, trade_date, close_price, COALESCE(sector_name, 'none') AS sector
FROM fund_prices f JOIN fund_meta m ON m.ticker = f.ticker""", "ticker d:trade_date f:close_price sector"))
def project_map_lookup(spark, sf_dir):
    prices = event_market(spark, sf_dir).fund_prices
    return filters.with_sector(prices, EVENT_FUND_SECTORS).select(
        "ticker", "trade_date", "close_price", F.coalesce("sector", F.lit("none")).alias("sector")
    )


@query("flag_trending", sql(LI + f"""
gains AS ({period_returns_sql('fund_prices', (5, 10, 20), 'point')}),
bench AS (SELECT period_days AS p, return_pct AS benchmark_return FROM gains WHERE ticker = '0'),
""", """SELECT *, return_pct > benchmark_return AND return_pct > 0 AS is_trending FROM gains JOIN bench ON p = period_days
WHERE ticker <> '0'""", "ticker i:period_days f:return_pct f:benchmark_return is_trending"))
def flag_trending(spark, sf_dir):
    m = line_market(spark, sf_dir)
    gains = materialized(returns.period_returns(m.fund_prices, kind="point"), "fund-returns")
    return portfolio.flag_trending(gains, m.benchmark).select(
        "ticker", "period_days", "return_pct", "benchmark_return", "is_trending"
    )


_CLASSIFIED = LI + f"""
recent AS (SELECT * FROM fund_prices WHERE trade_date >= {AS_OF} - 60),
gains AS ({point_returns_sql('recent')}),
classified AS (
  SELECT g.*, g.ticker IN ('0', '1', '2', '3', '4', '5') AS is_benchmark,
    g.ticker <> '0' AND return_pct > COALESCE((SELECT return_pct FROM gains WHERE ticker = '0'), 0)
      AND return_pct > 0 AS is_trending,
    CASE WHEN sector_name IS NULL THEN 'benchmark' ELSE 'sector' END AS category,
    COALESCE(sector_name, g.ticker) AS name
  FROM gains g LEFT JOIN fund_meta m ON m.ticker = g.ticker),
"""


def classified_funds(spark, sf_dir):
    m = line_market(spark, sf_dir, last_days=60)
    gains = materialized(returns.point_return(filters.trailing_days(m.fund_prices, m.clock, 60)), "fund-returns")
    reference = gains.filter(F.col("ticker") == m.benchmark).agg(F.max("return_pct").alias("r")).scalar()
    return filters.classify_funds(gains, m.fund_meta, reference, m.benchmark, m.benchmark_funds)


@query("classify_fund", sql(
    _CLASSIFIED, "SELECT * FROM classified", "ticker f:return_pct is_benchmark is_trending category name"))
def classify_fund(spark, sf_dir):
    return classified_funds(spark, sf_dir).select(
        "ticker", "return_pct", "is_benchmark", "is_trending", "category", "name"
    )


@query("fund_performance_table", sql(_CLASSIFIED, """
SELECT *, row_number() OVER (ORDER BY return_pct DESC, ticker) AS rank FROM classified WHERE day_count >= 2""",
    "i:rank ticker category name f:start_price f:end_price f:return_pct d:start_date d:end_date"))
def fund_performance_table(spark, sf_dir):
    return boards.fund_performance_table(classified_funds(spark, sf_dir))


def _ticker_sql(raw: str) -> str:
    return f"CASE WHEN regexp_matches(upper(trim({raw})), '^[A-Z][A-Z0-9.\\-]{{0,9}}$') THEN upper(trim({raw})) END"


@query("normalize_ticker", f"""
SELECT p_partkey, {_ticker_sql("' ' || lower(p_type) || '  '")} AS from_type, {_ticker_sql('p_brand')} AS from_brand,
  {_ticker_sql("replace(p_name, ' ', '.')")} AS from_name FROM part""")
def normalize_ticker(spark, sf_dir):
    return load(spark, sf_dir, "part").select(
        "p_partkey",
        C.normalized_ticker(F.concat(F.lit(" "), F.lower("p_type"), F.lit("  "))).alias("from_type"),
        C.normalized_ticker(F.col("p_brand")).alias("from_brand"),
        C.normalized_ticker(F.replace("p_name", F.lit(" "), F.lit("."))).alias("from_name"),
    )


@query("ticker_from_name", """
SELECT p_partkey,
  [w FOR w IN string_split_regex(p_name || ' ' || p_type || ' ' || 'AB12', '\\s+')
    IF w = upper(w) AND regexp_matches(w, '[A-Z]') AND length(w) <= 5][1] AS ticker,
  CASE WHEN p_size > 25 THEN p_brand ELSE substring(p_name, 1, 10) END AS head
FROM part""")
def ticker_from_name(spark, sf_dir):
    name = F.concat_ws(" ", "p_name", "p_type", F.lit("AB12"))
    return load(spark, sf_dir, "part").select(
        "p_partkey",
        C.ticker_from_name(name).alias("ticker"),
        C.ticker_or_name_head(F.when(F.col("p_size") > 25, F.col("p_brand")), F.col("p_name")).alias("head"),
    )


@query("default_fields", f"""
SELECT c_custkey, ticker, COALESCE(company_name, ticker) AS company_name, COALESCE(sector, 'Unknown') AS sector,
  COALESCE(market_cap, 0) AS market_cap FROM ({_LISTED_SQL}) listed""")
def default_fields(spark, sf_dir):
    return filters.with_defaults(_listed(spark, sf_dir))


# ---- scalar expressions --------------------------------------------------------

@query("scalar_functions_probe", """
SELECT o_orderkey,
  upper(trim(' ' || lower(o_orderpriority) || ' ')) AS priority,
  starts_with(o_orderpriority, '1') AS is_urgent,
  regexp_matches(o_orderpriority, '^[0-9]-') AS is_coded,
  string_split(o_orderpriority, '-')[2] AS priority_name,
  substring(o_orderpriority, 1, 3) AS priority_head,
  concat_ws(',', o_orderstatus, CASE WHEN o_totalprice > 200000 THEN 'large' END) AS tags,
  CAST(year(d) AS BIGINT) AS order_year, CAST(month(d) AS BIGINT) AS order_month,
  strftime(d, '%Y-%m-%d') AS iso_day, CAST(d - 7 AS VARCHAR) AS week_before, CAST(d + 28 AS VARCHAR) AS valid_until,
  CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month_start,
  abs(o_totalprice - 150000) > 100000 AS is_far,
  floor(COALESCE(o_totalprice / NULLIF(o_custkey % 3, 0), -1) * 1e6 + 5e-1) / 1e6 AS guarded_ratio,
  TRY_CAST(o_orderstatus AS DOUBLE) IS NULL AS status_is_text,
  CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS priority_code,
  CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE 'other' END AS status_name
FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders) o""")
def scalar_functions_probe(spark, sf_dir):
    day = F.to_date("o_orderdate")
    parts = F.split("o_orderpriority", "-")
    price = F.col("o_totalprice")
    status = C.lookup(F.col("o_orderstatus"), {"F": "filled", "O": "open"})
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.upper(F.trim(F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit(" ")))).alias("priority"),
        F.col("o_orderpriority").startswith("1").alias("is_urgent"),
        F.col("o_orderpriority").rlike("^[0-9]-").alias("is_coded"),
        F.get(parts, 1).alias("priority_name"),
        F.substring("o_orderpriority", 1, 3).alias("priority_head"),
        F.concat_ws(",", "o_orderstatus", F.when(price > 200000, "large")).alias("tags"),
        F.year(day).alias("order_year"), F.month(day).alias("order_month"),
        F.date_format(day, "yyyy-MM-dd").alias("iso_day"),
        F.date_sub(day, 7).alias("week_before"), F.date_add(day, 28).alias("valid_until"),
        F.trunc(day, "month").alias("month_start"),
        (F.abs(price - 150000) > 100000).alias("is_far"),
        F.coalesce(F.try_divide(price, F.col("o_custkey") % 3), F.lit(-1.0)).alias("guarded_ratio"),
        F.col("o_orderstatus").try_cast("double").isNull().alias("status_is_text"),
        F.get(parts, 0).try_cast("bigint").alias("priority_code"),
        F.coalesce(status, F.lit("other")).alias("status_name"),
    )


@query("calendar_flags", """
SELECT CAST(d AS VARCHAR) AS order_date, isodow(d) < 6 AS is_weekday,
  isodow(d) = 7 AND month(d + 7) <> month(d) AS is_last_sunday,
  isodow(d) >= 6 AND day(d) > day(last_day(d)) - 7 AS is_last_weekend
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) days""")
def calendar_flags(spark, sf_dir):
    days = load(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("order_date")).distinct()
    day = F.col("order_date")
    return days.select(
        "order_date", C.is_weekday(day).alias("is_weekday"), C.is_last_sunday(day).alias("is_last_sunday"),
        C.is_last_weekend(day).alias("is_last_weekend"),
    )


@query("nest_holdings", f"""{EV_TOP.rstrip().rstrip(',')}
SELECT etf_ticker, CAST(time_period AS BIGINT) AS time_period,
  to_json(list({{'rank_position': CAST(rank_position AS INTEGER), 'holding_ticker': holding_ticker,
    'holding_sector': holding_sector, 'market_cap': market_cap}} ORDER BY rank_position))::VARCHAR AS holdings
FROM top_holdings GROUP BY etf_ticker, time_period""")
def nest_holdings(spark, sf_dir):
    nested = boards.nest_holdings(
        event_top_holdings(spark, sf_dir), ["etf_ticker", "time_period"],
        ["rank_position", "holding_ticker", "holding_sector", "market_cap"], "rank_position",
    )
    return nested.withColumn("holdings", F.to_json("holdings"))


@query("trading_day_tail", sql(EV, f"""
SELECT ticker, trade_date, close_price FROM stock_prices WHERE trade_date >= {AS_OF} - 15
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) <= 10""", "ticker d:trade_date f:close_price"))
def trading_day_tail(spark, sf_dir):
    from fundtide.operators.windows import last_n_rows

    m = event_market(spark, sf_dir, last_days=15)
    return last_n_rows(m.stock_prices, 10).select("ticker", "trade_date", "close_price")


@query("explode_nested", sql(EV_TOP, """
SELECT etf_ticker, time_period, holding_ticker, rank_position FROM top_holdings""",
    "etf_ticker i:time_period holding_ticker i:rank_position"))
def explode_nested(spark, sf_dir):
    nested = boards.nest_holdings(
        event_top_holdings(spark, sf_dir), ["etf_ticker", "time_period"],
        ["rank_position", "holding_ticker"], "rank_position",
    )
    return nested.select("etf_ticker", "time_period", F.inline("holdings"))
