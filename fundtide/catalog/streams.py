"""Streaming jobs.  Each writes a topic from the given tables, runs to its end, and returns the table written."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundtide import schemas
from fundtide.catalog.base import EV, query, sql
from fundtide.sources import sinks, tables
from fundtide.sources.market import event_market, event_ticks
from fundtide.sources.workspace import new_folder
from fundtide.streaming import ingest

# Which event types become unusable messages: cut-off text, and no ticker.
BROKEN, NAMELESS = "error", "signup"


def _tick_topic(spark, sf_dir, deliveries: int = 1) -> str:
    """Every tick as a message, in several files; those of two event types arrive broken or nameless."""
    ticks = event_ticks(spark, sf_dir)
    ticker = F.when(F.col("fund") != NAMELESS, F.col("ticker"))
    body = F.to_json(F.struct(
        ticker.alias("ticker"), "sector", F.col("ts").alias("timestamp"),
        F.col("trade_date").cast("string").alias("date"), F.col("price").alias("current_price"),
        F.col("price").alias("high"), F.col("price").alias("low"), "volume",
    ))
    value = F.when(F.col("fund") == BROKEN, F.concat(F.lit("{ticker:"), body)).otherwise(body)
    rows = ticks.select(F.col("ticker").alias("key"), value.alias("value"))
    topic = new_folder(spark, "ticks")
    sinks.write_topic(rows.repartition(deliveries, "key") if deliveries > 1 else rows, topic)
    return topic


def _timed_ticks(spark, sf_dir):
    """Ticks with an instant as event time, which watermarks require."""
    return event_ticks(spark, sf_dir).select(
        "ticker", "sector", F.col("ts").cast("timestamp").alias("ts"), "price", "volume"
    )


@query("stream_upsert_bars", sql(
    EV, "SELECT * FROM stock_prices",
    "ticker company_name sector d:trade_date f:open_price f:high_price f:low_price f:close_price i:volume "
    "i:market_cap"))
def stream_upsert_bars(spark, sf_dir):
    bars = event_market(spark, sf_dir).stock_prices
    topic, table, dead, offsets = (new_folder(spark, n) for n in ("topic", "bars", "dead", "offsets"))
    # A preliminary bar (close = open) first, the final one in a later message.
    stages = F.explode(F.array(F.lit("T10"), F.lit("T20")))
    staged = bars.withColumn("stage", stages).select(
        "ticker", "company_name", "sector", "trade_date", "open_price", "high_price", "low_price",
        F.when(F.col("stage") == "T10", F.col("open_price")).otherwise(F.col("close_price")).alias("close_price"),
        "volume", "price_change_percent", "market_cap",
        F.concat(F.col("trade_date").cast("string"), "stage").alias("timestamp"),
    )
    sinks.write_topic(sinks.messages(staged, "ticker"), topic)
    ingest.upsert_bars(
        tables.topic_stream(spark, topic), schemas.STOCK_BAR_MESSAGE, table, dead, offsets
    )
    return spark.read.parquet(table).select(
        "ticker", "company_name", "sector", "trade_date", "open_price", "high_price", "low_price", "close_price",
        "volume", "market_cap",
    )


@query("stream_explode_holdings", sql(
    EV, "SELECT * FROM holdings",
    "etf_ticker holding_ticker holding_name f:holding_percent i:holding_shares f:holding_value d:as_of_date"))
def stream_explode_holdings(spark, sf_dir):
    holdings = event_market(spark, sf_dir).holdings
    topic, table, dead, offsets = (new_folder(spark, n) for n in ("topic", "holdings", "dead", "offsets"))
    item = F.struct(
        "etf_ticker", "holding_ticker", "holding_name", "holding_shares", "holding_value", "holding_percent",
        F.col("as_of_date").cast("string").alias("as_of_date"),
    )
    # A message carries a slice of a snapshot, so its size stays bounded however many names a fund holds.
    part = F.pmod(F.xxhash64("holding_ticker"), F.ceil(F.col("names") / 200).cast("bigint"))
    sizes = holdings.groupBy("etf_ticker", "as_of_date").agg(F.count("*").alias("names"))
    rows = (
        holdings.join(sizes, ["etf_ticker", "as_of_date"])
        .groupBy("etf_ticker", "as_of_date", part.alias("part"))
        .agg(F.collect_list(item).alias("holdings"))
        .select(
            "etf_ticker", F.size("holdings").alias("holdings_count"), "holdings",
            F.concat(F.col("as_of_date").cast("string"), F.lit("T00:00:00")).alias("timestamp"),
        )
    )
    sinks.write_topic(sinks.messages(rows, "etf_ticker"), topic)
    ingest.upsert_holdings(tables.topic_stream(spark, topic), schemas.HOLDINGS_MESSAGE, table, dead, offsets)
    return spark.read.parquet(table).select(
        "etf_ticker", "holding_ticker", "holding_name", "holding_percent", "holding_shares", "holding_value",
        "as_of_date",
    )


@query("holdings_dead_letters", sql(EV, """
SELECT CASE fund WHEN 'error' THEN 'malformed message' WHEN 'signup' THEN 'missing etf_ticker'
    WHEN 'view' THEN 'missing holdings' END AS error_msg, count(*) AS rejected
FROM (SELECT DISTINCT fund, user_id, d FROM ev) m WHERE fund IN ('error', 'signup', 'view') GROUP BY fund""",
    "error_msg i:rejected"))
def holdings_dead_letters(spark, sf_dir):
    """One message per fund, name and day; of three funds they are broken, nameless or empty."""
    topic, table, dead, offsets = (new_folder(spark, n) for n in ("topic", "holdings", "dead", "offsets"))
    ticks = event_ticks(spark, sf_dir).select("fund", "ticker", "trade_date").distinct()
    item = F.struct(F.col("ticker").alias("holding_ticker"), F.col("trade_date").cast("string").alias("as_of_date"))
    body = F.to_json(F.struct(
        F.when(F.col("fund") != NAMELESS, F.col("fund")).alias("etf_ticker"),
        F.filter(F.array(item), lambda _: F.col("fund") != "view").alias("holdings"),
    ))
    value = F.when(F.col("fund") == BROKEN, F.concat(F.lit("{etf_ticker:"), body)).otherwise(body)
    rows = ticks.select(F.col("fund").alias("key"), value.alias("value"))
    sinks.write_topic(rows.repartition(3, "key"), topic)
    ingest.upsert_holdings(
        tables.topic_stream(spark, topic, files_per_batch=1), schemas.HOLDINGS_MESSAGE, table, dead, offsets)
    return spark.read.parquet(dead).groupBy("error_msg").agg(F.count("*").alias("rejected"))


_HOURLY = sql(EV, """
SELECT ticker, sector, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
  CAST(sum(cents) AS DOUBLE) / count(*) / 100e0 AS avg_price, min(price) AS min_price, max(price) AS max_price,
  count(*) AS total_volume, count(*) AS record_count
FROM ev GROUP BY ticker, sector, date_trunc('hour', ts)""",
    "ticker sector window_start f:avg_price f:min_price f:max_price i:total_volume i:record_count")


def _hour_columns(hours):
    return hours.select(
        "ticker", "sector", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "avg_price", "min_price", "max_price", "total_volume", "record_count",
    )


def _hourly_table(spark, sf_dir, batches: int, merge_every: int):
    topic, table, offsets = (new_folder(spark, n) for n in ("ticks", "hours", "offsets"))
    # One file per micro-batch; an hour may lie in two of them.
    _timed_ticks(spark, sf_dir).repartitionByRange(batches, "ts").write.parquet(topic)
    ticks = spark.readStream.schema(
        "ticker string, sector string, ts timestamp, price double, volume bigint"
    ).option("maxFilesPerTrigger", 1).parquet(topic)
    ingest.hourly_to_table(ticks, table, offsets, merge_every=merge_every)
    return _hour_columns(ingest.latest_hours(ingest.hour_slices(spark, table)))


@query("hourly_tumbling_agg", _HOURLY)
def hourly_tumbling_agg(spark, sf_dir):
    return _hourly_table(spark, sf_dir, 4, ingest.MERGE_EVERY)


@query("hourly_merged", _HOURLY)
def hourly_merged(spark, sf_dir):
    """As above, with the closed slices merged every second batch."""
    return _hourly_table(spark, sf_dir, 7, 2)


@query("hourly_batch", _HOURLY)
def hourly_batch(spark, sf_dir):
    return _hour_columns(ingest.hourly(event_ticks(spark, sf_dir)))


@query("dead_letter_split", sql(EV, """
SELECT fund, CASE fund WHEN 'error' THEN 'malformed message' ELSE 'missing ticker' END AS error_msg,
  count(*) AS rejected, count(*) AS with_raw_value FROM ev WHERE fund IN ('error', 'signup') GROUP BY fund""",
    "error_msg i:rejected i:with_raw_value"))
def dead_letter_split(spark, sf_dir):
    table, dead, offsets = (new_folder(spark, n) for n in ("good", "dead", "offsets"))

    topic = _tick_topic(spark, sf_dir)
    ingest.split_messages(tables.topic_stream(spark, topic), schemas.TICK_MESSAGE, table, dead, offsets)
    return spark.read.parquet(dead).groupBy("error_msg").agg(
        F.count("*").alias("rejected"), F.count("raw_value").alias("with_raw_value")
    )


@query("dead_letter_good_rows", sql(
    EV, "SELECT ticker, sector, ts, price FROM ev WHERE fund NOT IN ('error', 'signup')",
    "ticker sector f:price"))
def dead_letter_good_rows(spark, sf_dir):
    topic = _tick_topic(spark, sf_dir)
    return ingest.good_rows(ingest.checked(tables.topic_batch(spark, topic), schemas.TICK_MESSAGE)).select(
        "ticker", "sector", F.col("current_price").alias("price")
    )


@query("stream_dedup", sql(
    EV, "SELECT ticker, sector, strftime(ts, '%Y-%m-%d %H:%M:%S') AS tick_time, price FROM ev",
    "ticker sector tick_time f:price"))
def stream_dedup(spark, sf_dir):
    topic, table, offsets = (new_folder(spark, n) for n in ("ticks", "unique", "offsets"))
    ticks = _timed_ticks(spark, sf_dir).drop("volume")
    # Every tick twice, the copy often in another file; each file is a micro-batch.
    copies = ticks.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    copies.repartition(4, "ticker", "copy").drop("copy").write.parquet(topic)
    stream = spark.readStream.schema("ticker string, sector string, ts timestamp, price double").option(
        "maxFilesPerTrigger", 1).parquet(topic)
    ingest.dedup_to_table(stream, ["ticker", "ts"], table, offsets)
    return ingest.tick_slices(spark, table, stream.schema).rows().select(
        "ticker", "sector", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("tick_time"), "price"
    )


@query("stream_progress", sql(EV, """
SELECT count(*) AS processed, count(*) FILTER (fund IN ('error', 'signup')) AS error_count FROM ev""",
    "i:processed i:error_count"))
def stream_progress(spark, sf_dir):
    table, progress, offsets = (new_folder(spark, n) for n in ("good", "progress", "offsets"))
    topic = _tick_topic(spark, sf_dir, deliveries=3)
    ingest.store_and_count(
        tables.topic_stream(spark, topic, files_per_batch=1), schemas.TICK_MESSAGE, table, progress, offsets
    )
    return ingest.progress_totals(spark.read.parquet(progress))


@query("stream_progress_reported", sql(EV, """
SELECT count(*) AS processed, count(*) FILTER (fund IN ('error', 'signup')) AS error_count FROM ev""",
    "i:processed i:error_count"))
def stream_progress_reported(spark, sf_dir):
    table, progress, offsets = (new_folder(spark, n) for n in ("good", "progress", "offsets"))
    topic = _tick_topic(spark, sf_dir, deliveries=3)
    ingest.store_and_report(
        tables.topic_stream(spark, topic, files_per_batch=1), schemas.TICK_MESSAGE, table, progress, offsets
    )
    return ingest.progress_totals(spark.read.parquet(progress))
