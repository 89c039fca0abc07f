"""Registry, output conventions and the shared SQL of the two test markets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundtide.functions.columns import rounded

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Output form both engines can produce: 6-digit doubles, 64-bit integers, ISO date texts."""
    def shape(field: T.StructField):
        column = F.col(field.name)
        kind = field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            column = rounded(column.cast("double"))
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        elif isinstance(kind, T.DateType):
            column = column.cast("string")
        return column.alias(field.name)

    return df.select(*[shape(f) for f in df.schema.fields])


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        if key in QUERIES:
            raise KeyError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: tidy(build(spark, sf_dir))
        if sql is not None:
            ORACLES[key] = sql
        return build

    return register


def sql(prefix: str, body: str, columns: str) -> str:
    """Wrap a body in the output form.

    ``columns`` lists the output; a mark sets the form: ``f:`` 6-digit double,
    ``i:`` 64-bit integer, ``d:`` ISO date text, none as it is.
    """
    shapes = {
        "f": "floor(CAST({c} AS DOUBLE) * 1e6 + 5e-1) / 1e6",
        "i": "CAST({c} AS BIGINT)",
        "d": "CAST(CAST({c} AS DATE) AS VARCHAR)",
    }
    items = []
    for item in columns.split():
        mark, _, name = item.rpartition(":")
        items.append(f"{shapes[mark].format(c=name) if mark else name} AS {name}")
    head = prefix.rstrip().rstrip(",") + ", " if prefix else "WITH "
    return f"{head}final_rows AS ({body}) SELECT {', '.join(items)} FROM final_rows"


def pct(new: str, old: str) -> str:
    return f"(({new}) - ({old})) / NULLIF({old}, 0) * 100e0"


AS_OF = "(SELECT d FROM clock)"

_BAR_CHANGE = """COALESCE((close_price - lag(close_price) OVER w) / NULLIF(lag(close_price) OVER w, 0) * 100e0, 0e0)
    AS price_change_percent"""

# Users as stocks, event types as funds.
EV = f"""
WITH ev AS (
  SELECT event_id AS seq, user_id, CAST(user_id AS VARCHAR) AS ticker, event_type AS fund, ts,
    'S' || CAST(user_id % 5 AS VARCHAR) AS sector,
    CAST(ts AS DATE) AS d, value AS price, CAST(floor(value * 100e0 + 5e-1) AS BIGINT) AS cents
  FROM events),
clock AS (SELECT max(d) AS d FROM ev),
stock_bars AS (
  SELECT user_id, ticker, sector, d AS trade_date, arg_min(price, seq) AS open_price, max(price) AS high_price,
    min(price) AS low_price, arg_max(price, seq) AS close_price, CAST(count(*) AS BIGINT) AS volume
  FROM ev GROUP BY user_id, ticker, sector, d),
stock_prices AS (
  SELECT ticker, 'User ' || ticker AS company_name, sector, trade_date, open_price, high_price, low_price,
    close_price, volume, {_BAR_CHANGE}, (user_id % 97 + 1) * 1000000000 AS market_cap
  FROM stock_bars WINDOW w AS (PARTITION BY ticker ORDER BY trade_date)),
fund_bars AS (
  SELECT fund AS ticker, d AS trade_date, arg_min(price, seq) AS open_price, max(price) AS high_price,
    min(price) AS low_price, CAST(sum(cents) AS DOUBLE) / count(*) / 100e0 AS close_price,
    CAST(count(*) AS BIGINT) AS volume
  FROM ev GROUP BY fund, d),
fund_prices AS (
  SELECT *, {_BAR_CHANGE} FROM fund_bars WINDOW w AS (PARTITION BY ticker ORDER BY trade_date)),
fund_meta AS (
  SELECT DISTINCT fund AS ticker, CASE WHEN fund = 'view' THEN 'benchmark' ELSE 'sector' END AS etf_type,
    CASE fund WHEN 'click' THEN 'S0' WHEN 'error' THEN 'S1' WHEN 'purchase' THEN 'S2'
      WHEN 'signup' THEN 'S3' END AS sector_name
  FROM ev),
positions AS (
  SELECT fund AS etf_ticker, ticker AS holding_ticker, CAST(date_trunc('week', d) AS DATE) AS as_of_date,
    CAST(count(*) AS BIGINT) AS holding_shares, CAST(sum(cents) AS BIGINT) AS value_cents
  FROM ev GROUP BY 1, 2, 3),
holdings AS (
  SELECT etf_ticker, holding_ticker, 'User ' || holding_ticker AS holding_name,
    CAST(value_cents AS DOUBLE) / NULLIF(sum(value_cents) OVER (PARTITION BY etf_ticker, as_of_date), 0) * 100e0
      AS holding_percent,
    holding_shares, value_cents / 100e0 AS holding_value, as_of_date
  FROM positions),
"""

# Suppliers as funds, parts as stocks.
LI = f"""
WITH li AS (
  SELECT l_suppkey, l_partkey, CAST(l_shipdate AS DATE) AS d, l_orderkey * 8 + l_linenumber AS seq,
    floor(l_extendedprice / l_quantity * 1e6 + 5e-1) / 1e6 AS price,
    CAST(floor(l_extendedprice / l_quantity * 1e6 + 5e-1) AS BIGINT) AS micros,
    CAST(l_quantity AS BIGINT) AS qty, CAST(floor(l_extendedprice * 100e0 + 5e-1) AS BIGINT) AS cents
  FROM lineitem),
clock AS (SELECT max(d) AS d FROM li),
fund_bars AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS ticker, d AS trade_date, arg_min(price, seq) AS open_price,
    max(price) AS high_price, min(price) AS low_price,
    CAST(sum(micros) AS DOUBLE) / count(*) / 1e6 AS close_price, CAST(sum(qty) AS BIGINT) AS volume
  FROM li GROUP BY l_suppkey, d),
fund_prices AS (
  SELECT *, {_BAR_CHANGE} FROM fund_bars WINDOW w AS (PARTITION BY ticker ORDER BY trade_date)),
fund_meta AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS ticker,
    CASE WHEN s_suppkey < 6 THEN 'benchmark' ELSE 'sector' END AS etf_type,
    CASE WHEN s_suppkey >= 6 THEN r_name END AS sector_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
attributes AS (
  SELECT p_partkey, p_name AS company_name, p_type AS sector,
    CAST(floor(p_retailprice * (p_size + 1) * 1000000 + 5e-1) AS BIGINT) AS market_cap
  FROM part),
stock_bars AS (
  SELECT l_partkey, d AS trade_date, arg_min(price, seq) AS open_price, max(price) AS high_price,
    min(price) AS low_price, arg_max(price, seq) AS close_price, CAST(sum(qty) AS BIGINT) AS volume
  FROM li GROUP BY l_partkey, d),
stock_prices AS (
  SELECT CAST(l_partkey AS VARCHAR) AS ticker, company_name, sector, trade_date, open_price, high_price,
    low_price, close_price, volume, {_BAR_CHANGE}, market_cap
  FROM stock_bars JOIN attributes ON p_partkey = l_partkey
  WINDOW w AS (PARTITION BY l_partkey ORDER BY trade_date)),
positions AS (
  SELECT l_suppkey, l_partkey, CAST(date_trunc('month', d) AS DATE) AS as_of_date,
    CAST(sum(qty) AS BIGINT) AS holding_shares, CAST(sum(cents) AS BIGINT) AS value_cents
  FROM li GROUP BY 1, 2, 3),
holdings AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS etf_ticker, CAST(l_partkey AS VARCHAR) AS holding_ticker,
    company_name AS holding_name,
    CAST(value_cents AS DOUBLE) / NULLIF(sum(value_cents) OVER (PARTITION BY l_suppkey, as_of_date), 0) * 100e0
      AS holding_percent,
    holding_shares, value_cents / 100e0 AS holding_value, as_of_date
  FROM positions JOIN attributes ON p_partkey = l_partkey),
"""


def period_returns_sql(
    source: str, periods: Sequence[int] = (5, 10, 20), kind: str = "range", coverage: float = 0.7
) -> str:
    first, last = (
        ("min(close_price)", "max(close_price)") if kind == "range"
        else ("arg_min(close_price, trade_date)", "arg_max(close_price, trade_date)")
    )
    values = ", ".join(f"({p})" for p in periods)
    return f"""SELECT *, {pct('last_close', 'first_close')} AS return_pct FROM (
    SELECT ticker, p AS period_days, {first} AS first_close, {last} AS last_close,
      min(trade_date) AS first_date, max(trade_date) AS last_date, count(*) AS day_count
    FROM (SELECT ticker, trade_date, close_price,
        row_number() OVER (PARTITION BY ticker ORDER BY trade_date DESC) AS rn FROM {source}) numbered
    JOIN (VALUES {values}) period(p) ON rn <= p
    GROUP BY ticker, p) summary WHERE day_count >= period_days * {coverage}"""


def point_returns_sql(source: str, keys: str = "ticker") -> str:
    return f"""SELECT *, {pct('end_price', 'start_price')} AS return_pct FROM (
    SELECT {keys}, arg_min(close_price, trade_date) AS start_price, arg_max(close_price, trade_date) AS end_price,
      min(trade_date) AS start_date, max(trade_date) AS end_date, count(*) AS day_count
    FROM {source} GROUP BY {keys}) summary WHERE start_price > 0"""


def latest_sql(source: str, keys: str, date: str) -> str:
    return f"""SELECT * FROM {source}
    QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {date} DESC) = 1"""


LI_TREND = LI + f"""
fund_returns AS ({period_returns_sql('fund_prices', (20,))}),
trend AS (
  SELECT {AS_OF} AS as_of_date, r.ticker AS etf_ticker, etf_type, sector_name, return_pct,
    (SELECT return_pct FROM fund_returns WHERE ticker = '0') AS benchmark_return,
    return_pct > (SELECT return_pct FROM fund_returns WHERE ticker = '0') AND return_pct > 0 AS is_trending,
    period_days, row_number() OVER (ORDER BY return_pct DESC, r.ticker) AS rank
  FROM fund_returns r LEFT JOIN fund_meta m ON m.ticker = r.ticker WHERE r.ticker <> '0'),
"""

# From usable stocks, holdings and the trend to one portfolio per period.
ALLOC_STEPS = f"""
stock_returns AS ({period_returns_sql('usable')}),
newest AS ({latest_sql('usable', 'ticker', 'trade_date')}),
pairs AS (SELECT DISTINCT etf_ticker, holding_ticker FROM holdings WHERE as_of_date >= {AS_OF} - 30),
candidates AS (
  SELECT p.etf_ticker, r.period_days, r.ticker, r.return_pct, n.company_name, n.sector, n.market_cap
  FROM stock_returns r JOIN newest n ON n.ticker = r.ticker AND n.market_cap > 0
  JOIN pairs p ON p.holding_ticker = r.ticker
  JOIN trend t ON t.etf_ticker = p.etf_ticker AND t.is_trending),
picks AS (
  SELECT *, return_pct * (1e0 / market_cap) AS allocation_score FROM candidates
  QUALIFY row_number() OVER (PARTITION BY etf_ticker, period_days ORDER BY return_pct DESC, ticker) = 1),
weighted AS (
  SELECT *, {AS_OF} AS as_of_date,
    CASE WHEN COALESCE(sum(allocation_score) OVER p, 0) <> 0
      THEN allocation_score / sum(allocation_score) OVER p * 100e0
      ELSE 100e0 / count(*) OVER p END AS weight,
    'top1_perf_per_etf_' || CAST(period_days AS VARCHAR) || 'd_score_perf_x_inv_mcap' AS allocation_reason
  FROM picks WINDOW p AS (PARTITION BY period_days)),
alloc AS (
  SELECT *, row_number() OVER (PARTITION BY period_days ORDER BY weight DESC, etf_ticker) AS rank FROM weighted),
"""

LI_ALLOC = LI_TREND + f"""
usable AS (
  SELECT * FROM stock_prices
  WHERE sector IS NOT NULL AND sector <> 'Unknown' AND NOT regexp_matches(ticker, '^(?i)STOCK[0-9]+$')
    AND NOT starts_with(upper(company_name), 'STOCK ')),
""" + ALLOC_STEPS + """
stock_alloc AS (
  SELECT as_of_date, period_days, ticker, max(company_name) AS company_name, max(sector) AS sector,
    max(market_cap) AS market_cap, max(return_pct) AS return_pct, sum(weight) / 100e0 AS portfolio_weight,
    max(allocation_reason) AS allocation_reason, count(*) AS fund_count, min(rank) AS rank
  FROM alloc GROUP BY as_of_date, period_days, ticker),
overlap AS (
  SELECT *, weight_20 IS NULL AS is_new,
    CASE WHEN weight_20 IS NOT NULL THEN 1.0 + CASE WHEN weight_10 IS NOT NULL THEN 1 ELSE 0 END
        + CASE WHEN weight_5 IS NOT NULL THEN 1 ELSE 0 END
      WHEN weight_10 IS NOT NULL AND weight_5 IS NOT NULL THEN 2.0
      WHEN weight_10 IS NOT NULL THEN 0.5 ELSE 0.3 END AS score,
    concat_ws(',', CASE WHEN weight_20 IS NOT NULL THEN '20d' END, CASE WHEN weight_10 IS NOT NULL THEN '10d' END,
      CASE WHEN weight_5 IS NOT NULL THEN '5d' END) AS source_periods
  FROM (
    SELECT as_of_date, ticker, max(company_name) AS company_name, max(sector) AS sector,
      max(market_cap) AS market_cap,
      COALESCE(max(return_pct) FILTER (period_days = 20), max(return_pct) FILTER (period_days = 5),
        max(return_pct) FILTER (period_days = 10)) AS return_20,
      COALESCE(max(allocation_reason) FILTER (period_days = 20), max(allocation_reason) FILTER (period_days = 5),
        max(allocation_reason) FILTER (period_days = 10)) AS allocation_reason,
      max(portfolio_weight) FILTER (period_days = 20) AS weight_20,
      max(portfolio_weight) FILTER (period_days = 10) AS weight_10,
      max(portfolio_weight) FILTER (period_days = 5) AS weight_5
    FROM stock_alloc GROUP BY as_of_date, ticker) merged),
overall AS (
  SELECT *, row_number() OVER (PARTITION BY as_of_date ORDER BY score DESC, return_20 DESC, ticker) AS overall_rank,
    row_number() OVER (PARTITION BY as_of_date, is_new ORDER BY score DESC, return_20 DESC, ticker) AS own_rank
  FROM overlap),
adjusted AS (
  SELECT *, row_number() OVER (PARTITION BY as_of_date
      ORDER BY CASE WHEN is_new THEN own_rank + 19 ELSE overall_rank END, is_new, ticker) AS final_rank
  FROM overall),
monthly AS (
  SELECT ticker, company_name, sector, final_rank, score / sum(score) OVER (PARTITION BY as_of_date) AS final_weight,
    score, source_periods, return_20 AS return_20d, market_cap, allocation_reason, as_of_date AS rebalance_date,
    as_of_date + 28 AS valid_until
  FROM adjusted WHERE final_rank <= 20),
"""

_METRIC_ROWS = f"""SELECT s.*, p AS period_days FROM stock_prices s
    JOIN (VALUES (5), (10), (20)) period(p) ON trade_date >= {AS_OF} - (p + 5)"""

EV_TOP = EV + f"""
metrics AS (
  SELECT *, {pct('current_price', 'first_close')} AS total_return FROM (
    SELECT ticker, period_days, arg_min(company_name, trade_date) AS holding_name,
      arg_min(sector, trade_date) AS holding_sector, arg_max(close_price, trade_date) AS current_price,
      arg_max(market_cap, trade_date) AS market_cap, avg(price_change_percent) AS avg_return,
      stddev_samp(price_change_percent) AS volatility, CAST(floor(avg(volume)) AS BIGINT) AS avg_volume,
      count(*) AS trading_days, arg_min(close_price, trade_date) AS first_close
    FROM ({_METRIC_ROWS}) windowed GROUP BY ticker, period_days) m
  WHERE trading_days >= period_days * 0.7),
newest_pairs AS ({latest_sql('holdings', 'etf_ticker, holding_ticker', 'as_of_date')}),
combined AS (
  SELECT h.etf_ticker, f.etf_type, f.sector_name, h.holding_ticker, h.holding_percent,
    COALESCE(m.holding_name, h.holding_name) AS holding_name, m.holding_sector, m.period_days, m.avg_return,
    m.total_return, m.volatility, m.avg_volume, m.current_price, m.market_cap, m.trading_days
  FROM newest_pairs h JOIN fund_meta f ON f.ticker = h.etf_ticker JOIN metrics m ON m.ticker = h.holding_ticker),
top_holdings AS (
  SELECT etf_ticker, etf_type, sector_name, holding_ticker, holding_name, holding_sector,
    period_days AS time_period,
    row_number() OVER (PARTITION BY etf_ticker, period_days ORDER BY total_return DESC, holding_ticker)
      AS rank_position,
    avg_return, total_return, volatility, avg_volume, current_price, market_cap, {AS_OF} AS as_of_date
  FROM combined QUALIFY rank_position <= 5),
"""


# ---- the same intermediate results on the Spark side --------------------------

def line_trending(spark: SparkSession, sf_dir: str, ranked: bool = False, described: bool = True) -> DataFrame:
    from fundtide.plans.jobs import trending_funds
    from fundtide.sources.market import line_market

    m = line_market(spark, sf_dir)
    meta = m.fund_meta if described else None
    return trending_funds(m.fund_prices, meta, m.benchmark, m.clock, slack_days=None, ranked=ranked)


def line_allocation(spark: SparkSession, sf_dir: str, ranked: bool = False) -> DataFrame:
    from fundtide.plans.jobs import portfolio_allocation
    from fundtide.sources.market import line_market

    m = line_market(spark, sf_dir)
    trending = line_trending(spark, sf_dir, described=False)
    return portfolio_allocation(
        trending, m.positions, m.stock_prices, m.clock, slack_days=None, ranked=ranked
    )


def line_stock_allocation(spark: SparkSession, sf_dir: str, ranked: bool = False) -> DataFrame:
    """The stored allocation table: later jobs read it several times, so it is written once."""
    from fundtide.operators.portfolio import roll_up_by_stock
    from fundtide.sources.workspace import materialized

    return materialized(roll_up_by_stock(line_allocation(spark, sf_dir, ranked)))


def line_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fundtide.plans.jobs import monthly_rebalance

    return monthly_rebalance(line_stock_allocation(spark, sf_dir))


def event_top_holdings(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    """Top holdings; ``stored`` writes them first, for queries that read them several times."""
    from fundtide.plans.jobs import fund_top_holdings
    from fundtide.sources.market import event_market
    from fundtide.sources.workspace import materialized

    m = event_market(spark, sf_dir)
    top = fund_top_holdings(m.held_fund_meta, m.holdings, m.stored_stock_prices, m.stored_clock)
    return materialized(top, "top-holdings") if stored else top
