"""One schema per table and message.

Prices and percentages are declared as the decimals of the table edge; the
operators compute in double and cast on the way out (see ``to_table``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT, DATE, LONG, INT = T.StringType(), T.DateType(), T.LongType(), T.IntegerType()
DOUBLE, FLAG, TIME, LOCAL_TIME = T.DoubleType(), T.BooleanType(), T.TimestampType(), T.TimestampNTZType()
PRICE, PERCENT3, PERCENT4 = T.DecimalType(10, 2), T.DecimalType(6, 3), T.DecimalType(10, 4)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _bar(price: T.DataType, change: T.DataType) -> dict[str, T.DataType]:
    return dict(
        trade_date=DATE, open_price=price, high_price=price, low_price=price, close_price=price,
        volume=LONG, price_change_percent=change,
    )


FUND_META = _schema(ticker=TEXT, etf_type=TEXT, sector_name=TEXT)
FUND_PRICES = _schema(ticker=TEXT, **_bar(PRICE, PERCENT3))
STOCK_PRICES = _schema(ticker=TEXT, company_name=TEXT, sector=TEXT, **_bar(PRICE, PERCENT3), market_cap=LONG)
HOLDINGS = _schema(
    etf_ticker=TEXT, holding_ticker=TEXT, holding_name=TEXT, holding_percent=T.DecimalType(8, 4),
    holding_shares=T.DecimalType(20, 4), holding_value=T.DecimalType(20, 2), as_of_date=DATE, source=TEXT,
)
TRENDING = _schema(
    etf_ticker=TEXT, as_of_date=DATE, period=INT, return_pct=PERCENT4, is_trending=FLAG, rank=INT
)
ALLOCATION = _schema(
    as_of_date=DATE, ticker=TEXT, company_name=TEXT, sector=TEXT, market_cap=LONG, return_pct=PERCENT4,
    sector_avg=PERCENT4, is_trending=FLAG, rank=INT, portfolio_weight=T.DecimalType(8, 5),
    allocation_reason=TEXT, period_days=INT,
)
SECTOR_TRENDING = _schema(
    year=INT, month=INT, sector=TEXT, stock_count=INT, avg_monthly_return=PERCENT3, volatility=PERCENT3,
    positive_days=INT, total_trading_days=INT, positive_rate=T.DecimalType(5, 2), best_day=PERCENT3,
    worst_day=PERCENT3, is_trending=FLAG,
)
STOCK_TRENDING = _schema(
    year=INT, month=INT, ticker=TEXT, company_name=TEXT, sector=TEXT, avg_monthly_return=PERCENT3,
    vs_sector=PERCENT3, volatility=PERCENT3, total_volume=LONG, month_high=PRICE, month_low=PRICE,
    trading_days=INT, is_trending=FLAG,
)
MONTHLY_PORTFOLIO = _schema(
    ticker=TEXT, company_name=TEXT, sector=TEXT, final_rank=INT, final_weight=T.DecimalType(10, 6),
    score=PRICE, source_periods=TEXT, return_20d=PRICE, market_cap=LONG, allocation_reason=TEXT,
    rebalance_date=DATE, valid_until=DATE,
)
TOP_HOLDINGS = _schema(
    etf_ticker=TEXT, etf_type=TEXT, sector_name=TEXT, holding_ticker=TEXT, holding_name=TEXT,
    holding_sector=TEXT, time_period=INT, rank_position=INT, avg_return=PERCENT4, total_return=PERCENT4,
    volatility=PERCENT4, avg_volume=LONG, current_price=PRICE, market_cap=LONG, as_of_date=DATE,
)
DEAD_LETTER = _schema(raw_value=TEXT, error_msg=TEXT, received_at=TIME)

TICK_MESSAGE = _schema(
    ticker=TEXT, sector=TEXT, timestamp=LOCAL_TIME, date=TEXT, current_price=DOUBLE, high=DOUBLE,
    low=DOUBLE, volume=LONG,
)
FUND_BAR_MESSAGE = _schema(
    ticker=TEXT, **_bar(DOUBLE, DOUBLE), timestamp=TEXT, etf_type=TEXT, sector_name=TEXT
)
STOCK_BAR_MESSAGE = _schema(
    ticker=TEXT, company_name=TEXT, sector=TEXT, **_bar(DOUBLE, DOUBLE), market_cap=LONG, timestamp=TEXT
)
HOLDINGS_MESSAGE = _schema(
    etf_ticker=TEXT, etf_type=TEXT, sector_name=TEXT, holdings_count=INT,
    holdings=T.ArrayType(_schema(
        etf_ticker=TEXT, holding_ticker=TEXT, holding_name=TEXT, holding_shares=LONG, holding_value=DOUBLE,
        holding_percent=DOUBLE, date_reported=TEXT, as_of_date=TEXT,
    )),
    timestamp=TEXT,
)
TOPIC = _schema(key=TEXT, value=TEXT)


def to_table(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto a table schema: declared order and types, absent columns as NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
