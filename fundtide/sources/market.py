"""Adapters: how the supplied tables stand in for a fund market.

A :class:`Market` holds the four base tables every operator works on:

``fund_meta``     ticker, etf_type, sector_name
``fund_prices``   ticker, trade_date, OHLC, volume, price_change_percent
``stock_prices``  ticker, company_name, sector, trade_date, OHLC, volume,
                  price_change_percent, market_cap
``holdings``      etf_ticker, holding_ticker, holding_name, holding_percent,
                  holding_shares, holding_value, as_of_date, source

Frames are lazy and columns nobody asks for are pruned, including the window
behind ``price_change_percent``.  Bars are unique per (ticker, trade_date), so a
ticker never has more rows than the calendar has days; all work on raw rows
happens in partial hash aggregates (primitive buffers) before any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fundtide.functions.columns import lookup, minor_units, rounded
from fundtide.functions.dates import Clock, day
from fundtide.operators.positions import Book
from fundtide.operators.windows import daily_change
from fundtide.sources.stored_bars import CHANGE, StoredBars
from fundtide.sources.workspace import kept_folder, materialized, version

# The sector each sector fund of the event market stands for.
EVENT_FUND_SECTORS = {"click": "S0", "error": "S1", "purchase": "S2", "signup": "S3"}
EVENT_FUNDS = ("click", "error", "purchase", "signup", "view")

Frame = Callable[[], DataFrame]


class Market:
    """The base tables of a market; each is planned on first use."""

    def __init__(
        self,
        fund_meta: Frame,
        fund_prices: Frame,
        stock_prices: Frame,
        positions: Frame,
        book: Callable[[], Book],
        describe: Callable[[DataFrame], DataFrame],
        benchmark: str,
        benchmark_funds: tuple[str, ...],
        clock: Clock,
        facts: tuple[SparkSession, str, str] | None,
    ):
        self._facts = facts
        self._build = dict(
            fund_meta=fund_meta, fund_prices=fund_prices, stock_prices=stock_prices, positions=positions, book=book
        )
        self._describe = describe
        self.clock = clock
        self.benchmark = benchmark
        self.benchmark_funds = benchmark_funds

    @cached_property
    def fund_meta(self) -> DataFrame:
        return self._build["fund_meta"]()

    @cached_property
    def fund_prices(self) -> DataFrame:
        return self._build["fund_prices"]()

    @cached_property
    def stock_prices(self) -> DataFrame:
        return self._build["stock_prices"]()

    @cached_property
    def stored_fund_prices(self) -> DataFrame:
        """As ``fund_prices``, from the table with the stored change, with ``trade_month``."""
        return self._stored("fund-bars", "fund_prices")

    @cached_property
    def stored_stock_prices(self) -> DataFrame:
        """As ``stock_prices``, from the table with the stored change, with ``trade_month``."""
        return self._stored("stock-bars", "stock_prices")

    @cached_property
    def stored_fund_meta(self) -> DataFrame:
        """Metadata of the funds that have stored bars."""
        return self._build["fund_meta"](self.stored_fund_prices.select("ticker").distinct())

    @cached_property
    def stored_clock(self) -> Clock:
        """The newest day of the stored bars."""
        return Clock(self.stored_stock_prices, F.col("trade_date"))

    def _stored(self, name: str, bars: str) -> DataFrame:
        if self._facts is None:
            raise ValueError("a market of the last days only has no stored history")
        return stored(*self._facts, name, self._build[bars])

    @cached_property
    def positions(self) -> DataFrame:
        """Holdings without percent and name, for jobs that need only the pairs."""
        return self._build["positions"]()

    @cached_property
    def book(self) -> Book:
        """Positions and totals of all snapshots: the trades are read once, when first asked for."""
        return self._build["book"]()

    @cached_property
    def holdings(self) -> DataFrame:
        return self._describe(self.book.with_share("value_cents")).drop("arrival")

    @cached_property
    def snapshot(self) -> DataFrame:
        """Holdings of every fund's newest snapshot, with ``arrival``, the number of the first raw row of each.

        Written once: jobs look up a fund's newest date in it and join it back.
        """
        return materialized(self._describe(self.book.with_share("value_cents", newest=True)), "snapshot")

    @cached_property
    def newest_pairs(self) -> DataFrame:
        """(etf_ticker, holding_ticker, as_of_date) of every fund's newest snapshot, without percent and name."""
        held = self.book.positions.join(self.book.newest(), [self.book.fund, self.book.snapshot])
        return held.select(
            F.col(self.book.fund).cast("string").alias("etf_ticker"),
            F.col(self.book.stock).cast("string").alias("holding_ticker"), "as_of_date")

    @cached_property
    def held_fund_meta(self) -> DataFrame:
        """Metadata of the funds in the book, without another read of the trades."""
        names = self.book.totals.select(F.col(self.book.fund).cast("string").alias("ticker")).distinct()
        return self._build["fund_meta"](names)

    def as_of(self, days_back: int = 0) -> Column:
        """Newest trade date minus ``days_back``."""
        return day(self.clock, days_back)


#: (version of the facts, table) by session, facts and name.
_stored: dict[tuple, tuple[tuple, StoredBars]] = {}


def stored(spark: SparkSession, sf_dir: str, facts: str, name: str, bars: Frame) -> DataFrame:
    """The bars of a market from a table with a stored change, by month.

    The table is made from the facts on first use and again when their files have changed;
    trailing queries then read their months and no raw row.  A collector would keep it with
    ``StoredBars.upsert``.
    """
    path = f"{sf_dir}/{facts}.parquet"
    key = (spark.sparkContext.applicationId, path, name)
    state = version(spark, path)
    if _stored.get(key, (None, None))[0] != state:
        rows = bars().drop(CHANGE)
        table = StoredBars(spark, kept_folder(spark, name), rows.schema)
        table.create(rows)
        _stored[key] = (state, table)
    return _stored[key][1].bars()


@cache
def _schema_of(spark: SparkSession, path: str) -> StructType:
    """Schema of a table, read from its footers once per session."""
    return spark.read.parquet(path).schema


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    path = f"{sf_dir}/{table}.parquet"
    return spark.read.schema(_schema_of(spark, path)).parquet(path)


def _since(raw: DataFrame, ts: str, clock: Clock, last_days: int | None) -> DataFrame:
    """Keep raw rows of the last days, dropped in the scan stage before any grouping."""
    if last_days is None:
        return raw
    return raw.filter(F.col(ts) >= day(clock, last_days).cast("timestamp_ntz"))


def _clock_of(spark: SparkSession, sf_dir: str, table: str, ts: str) -> Clock:
    return Clock(load(spark, sf_dir, table), F.col(ts))


def _measures() -> list[Column]:
    """What a position has besides its value; ``arrival`` is the number of its first raw row."""
    return [F.sum("volume").alias("holding_shares"), F.min("seq").alias("arrival")]


def event_ticks(
    spark: SparkSession, sf_dir: str, last_days: int | None = None, clock: Clock | None = None
) -> DataFrame:
    """``events`` as ticks: one row per trade of one unit."""
    clock = clock or _clock_of(spark, sf_dir, "events", "ts")
    raw = _since(load(spark, sf_dir, "events"), "ts", clock, last_days)
    return raw.select(
        F.col("event_id").alias("seq"),
        "user_id",
        F.col("user_id").cast("string").alias("ticker"),
        F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string")).alias("sector"),
        F.col("event_type").alias("fund"),
        "ts",
        F.to_date("ts").alias("trade_date"),
        F.col("value").alias("price"),
        minor_units(F.col("value")).alias("cents"),
        F.lit(1).cast("bigint").alias("volume"),
    )


def event_market(spark: SparkSession, sf_dir: str, last_days: int | None = None) -> Market:
    """Dense calendar: users are stocks, event types are funds, ``view`` is the benchmark.

    ``last_days`` reads only the newest days.  The first bar in such a slice has
    no predecessor, so queries that use daily changes leave it unset.
    """
    events = load(spark, sf_dir, "events")
    clock = _clock_of(spark, sf_dir, "events", "ts")

    @cache
    def ticks() -> DataFrame:
        return event_ticks(spark, sf_dir, last_days, clock)

    def stock_prices() -> DataFrame:
        bars = ticks().groupBy("user_id", "trade_date").agg(
            # The event number settles ticks of the same instant.
            F.min_by("price", "seq").alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", "seq").alias("close_price"),
            F.sum("volume").alias("volume"),
        )
        return daily_change(bars, key="user_id").select(
            F.col("user_id").cast("string").alias("ticker"),
            F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("company_name"),
            F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string")).alias("sector"),
            "trade_date", "open_price", "high_price", "low_price", "close_price", "volume",
            "price_change_percent",
            ((F.col("user_id") % 97 + 1) * 1000000000).alias("market_cap"),
        )

    def fund_prices() -> DataFrame:
        return daily_change(ticks().groupBy(F.col("fund").alias("ticker"), "trade_date").agg(
            F.min_by("price", "seq").alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            (F.sum("cents") / F.count("*") / F.lit(100.0)).alias("close_price"),
            F.sum("volume").alias("volume"),
        ))

    def fund_meta(names: DataFrame | None = None) -> DataFrame:
        if names is None:
            names = events.select(F.col("event_type").alias("ticker")).distinct()
        return names.select(
            "ticker",
            F.when(F.col("ticker") == "view", "benchmark").otherwise("sector").alias("etf_type"),
            lookup(F.col("ticker"), EVENT_FUND_SECTORS).alias("sector_name"),
        )

    def positions() -> DataFrame:
        return ticks().groupBy(
            F.col("fund").alias("etf_ticker"), "user_id", F.trunc("trade_date", "week").alias("as_of_date")
        ).agg(F.sum("volume").alias("holding_shares"), F.sum("cents").alias("value_cents")).withColumn(
            "holding_ticker", F.col("user_id").cast("string"))

    def book() -> Book:
        trades = ticks().select(
            F.col("fund").alias("etf_ticker"), "user_id", F.trunc("trade_date", "week").alias("as_of_date"),
            F.col("cents").alias("value_cents"), "volume", "seq")
        return Book.of(trades, "etf_ticker", "user_id", "as_of_date", "value_cents", _measures())

    def describe(held: DataFrame) -> DataFrame:
        return held.withColumn("holding_ticker", F.col("user_id").cast("string")).select(
            "etf_ticker", "holding_ticker",
            F.concat(F.lit("User "), F.col("holding_ticker")).alias("holding_name"),
            "holding_percent", "holding_shares",
            (F.col("value_cents") / F.lit(100.0)).alias("holding_value"),
            "as_of_date", F.lit("events").alias("source"), "arrival",
        )

    return Market(
        fund_meta, fund_prices, stock_prices, positions, book, describe,
        benchmark="view", benchmark_funds=("view",), clock=clock, facts=None if last_days else (spark, sf_dir, "events"),
    )


def line_market(spark: SparkSession, sf_dir: str, last_days: int | None = None) -> Market:
    """Wide and sparse: suppliers are funds, parts are stocks, supplier 0 is the benchmark."""
    raw = load(spark, sf_dir, "lineitem")
    clock = _clock_of(spark, sf_dir, "lineitem", "l_shipdate")

    @cache
    def lines() -> DataFrame:
        price = F.col("l_extendedprice") / F.col("l_quantity")
        return _since(raw, "l_shipdate", clock, last_days).select(
            "l_suppkey", "l_partkey",
            F.to_date("l_shipdate").alias("trade_date"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
            rounded(price).alias("price"),
            minor_units(price, 6).alias("micros"),
            F.col("l_quantity").cast("bigint").alias("volume"),
            minor_units(F.col("l_extendedprice")).alias("value_cents"),
        )

    @cache
    def attributes() -> DataFrame:
        return load(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("l_partkey"),
            F.col("p_name").alias("company_name"),
            F.col("p_type").alias("sector"),
            minor_units(F.col("p_retailprice") * (F.col("p_size") + 1) * 1000000, 0).alias("market_cap"),
        )

    def fund_prices() -> DataFrame:
        bars = lines().groupBy("l_suppkey", "trade_date").agg(
            F.min_by("price", "seq").alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            (F.sum("micros") / F.count("*") / F.lit(1000000.0)).alias("close_price"),
            F.sum("volume").alias("volume"),
        )
        return daily_change(bars, key="l_suppkey").select(
            F.col("l_suppkey").cast("string").alias("ticker"),
            "trade_date", "open_price", "high_price", "low_price", "close_price", "volume",
            "price_change_percent",
        )

    def fund_meta(names: DataFrame | None = None) -> DataFrame:
        is_benchmark = F.col("s_suppkey") < 6
        nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
        suppliers = load(spark, sf_dir, "supplier")
        if names is not None:
            suppliers = suppliers.join(names, F.col("s_suppkey").cast("string") == F.col("ticker"), "left_semi")
        return (
            suppliers
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("s_suppkey").cast("string").alias("ticker"),
                F.when(is_benchmark, "benchmark").otherwise("sector").alias("etf_type"),
                F.when(~is_benchmark, F.col("r_name")).alias("sector_name"),
            )
        )

    def stock_prices() -> DataFrame:
        bars = lines().groupBy("l_partkey", "trade_date").agg(
            F.min_by("price", "seq").alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", "seq").alias("close_price"),
            F.sum("volume").alias("volume"),
        )
        return daily_change(bars, key="l_partkey").join(attributes(), "l_partkey").select(
            F.col("l_partkey").cast("string").alias("ticker"),
            "company_name", "sector", "trade_date", "open_price", "high_price", "low_price",
            "close_price", "volume", "price_change_percent", "market_cap",
        )

    def positions() -> DataFrame:
        return lines().groupBy("l_suppkey", "l_partkey", F.trunc("trade_date", "month").alias("as_of_date")).agg(
            F.sum("volume").alias("holding_shares"), F.sum("value_cents").alias("value_cents")
        ).select(
            F.col("l_suppkey").cast("string").alias("etf_ticker"),
            F.col("l_partkey").cast("string").alias("holding_ticker"),
            "as_of_date", "holding_shares", "value_cents",
        )

    def book() -> Book:
        trades = lines().select(
            "l_suppkey", "l_partkey", F.trunc("trade_date", "month").alias("as_of_date"), "value_cents", "volume", "seq")
        return Book.of(trades, "l_suppkey", "l_partkey", "as_of_date", "value_cents", _measures())

    def describe(held: DataFrame) -> DataFrame:
        names = attributes().select("l_partkey", F.col("company_name").alias("holding_name"))
        return held.join(names, "l_partkey").select(
            F.col("l_suppkey").cast("string").alias("etf_ticker"),
            F.col("l_partkey").cast("string").alias("holding_ticker"),
            "holding_name", "holding_percent", "holding_shares",
            (F.col("value_cents") / F.lit(100.0)).alias("holding_value"),
            "as_of_date", F.lit("lineitem").alias("source"), "arrival",
        )

    return Market(
        fund_meta, fund_prices, stock_prices, positions, book, describe,
        benchmark="0", benchmark_funds=("0", "1", "2", "3", "4", "5"), clock=clock, facts=None if last_days else (spark, sf_dir, "lineitem"),
    )
