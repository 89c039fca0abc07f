"""Streams of JSON messages into tables.

Every job reads (key, value) messages, keeps its offsets in a checkpoint folder
and writes through an idempotent sink, so a replayed batch changes nothing.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from fundtide.functions.columns import ticker_or_name_head
from fundtide.operators.windows import top_k_per_group
from fundtide.sources import sinks, workspace
from fundtide.sources.slices import Slices

_CORRUPT = "_corrupt_record"


def parsed(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Messages with their content in ``data`` and unreadable text in ``corrupt``.

    A malformed message yields a struct of NULLs, so the corrupt-record field -
    not a NULL struct - tells it apart.
    """
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    content = F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    return messages.withColumn("_all", content).select(
        "value",
        F.struct(*[F.col(f"_all.{f.name}").alias(f.name) for f in schema.fields]).alias("data"),
        F.col(f"_all.{_CORRUPT}").alias("corrupt"),
    )


def problem(required: Sequence[str]) -> Column:
    """Why a parsed message cannot be stored, or NULL."""
    reasons = F.when(F.col("corrupt").isNotNull(), "malformed message")
    for name in required:
        field = F.col(f"data.{name}")
        missing = field.isNull()
        reasons = reasons.when(missing, f"missing {name}")
    return reasons


def checked(messages: DataFrame, schema: T.StructType, required: Sequence[str] = ("ticker",)) -> DataFrame:
    return parsed(messages, schema).withColumn("error_msg", problem(required))


def dead_letters(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("error_msg").isNotNull()).select(
        F.col("value").alias("raw_value"), "error_msg", F.current_timestamp().alias("received_at")
    )


def good_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("error_msg").isNull()).select("data.*")


def run_to_end(
    writer: DataStreamWriter, checkpoint: str, each_batch: Callable[[DataFrame, int], None] | None = None
) -> StreamingQuery:
    """Process everything available, then stop.  A failed query raises."""
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    started = (writer.foreachBatch(each_batch) if each_batch else writer).start()
    started.awaitTermination()
    return started


def with_month(bars: DataFrame) -> DataFrame:
    return bars.withColumn("trade_month", F.trunc("trade_date", "month"))


def upsert_bars(
    messages: DataFrame, schema: T.StructType, table: str, dead_table: str, checkpoint: str,
    required: Sequence[str] = ("ticker", "trade_date"),
) -> StreamingQuery:
    """Bar messages into a table keyed by (ticker, trade_date); rejects into the dead-letter table.

    Inside a batch the message with the latest ``timestamp`` wins; a later batch
    beats an earlier one.  Dead letters are written per batch, so a replay
    replaces them.
    """
    # Equal stamps are settled by content, so that a replay gives the same rows.
    newest = [F.col("timestamp").desc_nulls_last(), F.xxhash64("*").desc()]

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = checked(batch, schema, required).persist()
        bars = with_month(good_rows(rows))
        sinks.upsert_rows(bars, table, ["ticker", "trade_date"], "trade_month", newest)
        sinks.replace_slices(
            dead_letters(rows).withColumn("batch_id", F.lit(batch_id)), dead_table, ["batch_id"]
        )
        rows.unpersist()

    return run_to_end(messages.writeStream, checkpoint, store)


def holding_rows(messages: DataFrame) -> DataFrame:
    """One row per holding of each fund message, with defaults for missing fields."""
    items = messages.select("etf_ticker", "timestamp", F.explode("holdings").alias("h"))
    return items.select(
        "etf_ticker",
        ticker_or_name_head(F.col("h.holding_ticker"), F.col("h.holding_name")).alias("holding_ticker"),
        F.col("h.holding_name").alias("holding_name"),
        F.col("h.holding_percent").alias("holding_percent"),
        F.col("h.holding_shares").alias("holding_shares"),
        F.col("h.holding_value").alias("holding_value"),
        F.coalesce(F.to_date("h.as_of_date"), F.to_date(F.substring("timestamp", 1, 10))).alias("as_of_date"),
        F.lit("stream").alias("source"),
        "timestamp",
    )


def upsert_holdings(
    messages: DataFrame, schema: T.StructType, table: str, dead_table: str, checkpoint: str
) -> StreamingQuery:
    """Fund messages into holdings keyed by (etf_ticker, holding_ticker, as_of_date).

    Unreadable messages, and those without a fund or without holdings, go to the dead-letter
    table, one slice per batch.  A holding without any date is stored under a NULL date.
    """
    newest = [F.col("timestamp").desc_nulls_last(), F.xxhash64("*").desc()]

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = checked(batch, schema, ["etf_ticker", "holdings"]).withColumn(
            "error_msg", F.coalesce("error_msg", F.when(F.size("data.holdings") == 0, "missing holdings"))
        ).persist()
        sinks.upsert_rows(
            holding_rows(good_rows(rows)), table, ["etf_ticker", "holding_ticker", "as_of_date"], "as_of_date", newest
        )
        sinks.replace_slices(
            dead_letters(rows).withColumn("batch_id", F.lit(batch_id)), dead_table, ["batch_id"]
        )
        rows.unpersist()

    return run_to_end(messages.writeStream, checkpoint, store)


def split_messages(
    messages: DataFrame, schema: T.StructType, table: str, dead_table: str, checkpoint: str,
    required: Sequence[str] = ("ticker",),
) -> StreamingQuery:
    """Good rows into one table and dead letters into another, one slice per batch each."""
    def store(batch: DataFrame, batch_id: int) -> None:
        rows = checked(batch, schema, required).persist()
        for part, path in ((good_rows(rows), table), (dead_letters(rows), dead_table)):
            sinks.replace_slices(part.withColumn("batch_id", F.lit(batch_id)), path, ["batch_id"])
        rows.unpersist()

    return run_to_end(messages.writeStream, checkpoint, store)


HOUR_KEYS = ("ticker", "sector", "window_start")


def hourly(ticks: DataFrame, ts: str = "ts") -> DataFrame:
    """Mean, extremes, volume and count per ticker, sector and hour."""
    return _hours(_hour_parts(ticks, ts))


def _hour_parts(ticks: DataFrame, ts: str) -> DataFrame:
    """Sums from which hourly figures are made; parts of one hour may be added up."""
    return ticks.groupBy(F.window(ts, "1 hour").alias("hour"), "ticker", "sector").agg(
        F.sum("price").alias("price_sum"), F.count("price").alias("price_count"), F.min("price").alias("min_price"),
        F.max("price").alias("max_price"), F.sum("volume").alias("total_volume"), F.count("*").alias("record_count"),
    ).select("ticker", "sector", F.col("hour.start").alias("window_start"), F.col("hour.end").alias("window_end"),
             "price_sum", "price_count", "min_price", "max_price", "total_volume", "record_count")


def _hours(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*HOUR_KEYS, "window_end").agg(
        F.try_divide(F.sum("price_sum"), F.sum("price_count")).alias("avg_price"),
        F.min("min_price").alias("min_price"), F.max("max_price").alias("max_price"),
        F.sum("total_volume").alias("total_volume"), F.sum("record_count").alias("record_count"),
    )


def _add_parts(parts: DataFrame) -> DataFrame:
    """Parts of the same hour as one part."""
    return parts.groupBy(*HOUR_KEYS, "window_end", "day").agg(
        F.sum("price_sum").alias("price_sum"), F.sum("price_count").alias("price_count"),
        F.min("min_price").alias("min_price"), F.max("max_price").alias("max_price"),
        F.sum("total_volume").alias("total_volume"), F.sum("record_count").alias("record_count"))


def _columns(**kinds: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StructType().add(name, kind)[0].dataType) for name, kind in kinds.items()])


HOUR_PARTS = _columns(
    ticker="string", sector="string", window_start="timestamp", window_end="timestamp", price_sum="double", price_count="long",
    min_price="double", max_price="double", total_volume="long", record_count="long", day="date")

#: Batches whose slices lie about before they are merged.
MERGE_EVERY = 16


def hour_slices(spark: SparkSession, table: str) -> Slices:
    """The stored sums of :func:`hourly_to_table`."""
    return Slices(spark, table, HOUR_PARTS, "day", _add_parts)


def hourly_to_table(
    ticks: DataFrame, table: str, checkpoint: str, ts: str = "ts", merge_every: int = MERGE_EVERY
) -> StreamingQuery:
    """Hourly sums of every micro-batch, one slice per batch, merged by day every so many batches.

    No row is ever late: a tick that arrives days after its hour adds a part to it.  A replay
    replaces its own slice.  ``latest_hours`` adds the parts up.  When a batch runs, all
    earlier ones are closed, so these are merged.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        slices = hour_slices(batch.sparkSession, table)
        slices.put(_hour_parts(batch, ts).withColumn("day", F.to_date("window_start")), batch_id)
        _merge_now_and_then(slices, batch_id, merge_every)

    return run_to_end(ticks.writeStream, checkpoint, store)


def _merge_now_and_then(slices: Slices, batch_id: int, merge_every: int) -> None:
    if batch_id and batch_id % merge_every == 0:
        slices.compact(batch_id)


def latest_hours(slices: Slices) -> DataFrame:
    """The figures of every hour from all batches so far."""
    return _hours(slices.rows())


def open_hours(ticks: DataFrame, delay: str, ts: str = "ts") -> DataFrame:
    """Hourly figures as a stream with a watermark, for dashboards that need not be complete.

    Ticks more than ``delay`` behind the newest are not counted; ``hourly_to_table`` counts all.
    """
    return ticks.withWatermark(ts, delay).groupBy(F.window(ts, "1 hour").alias("hour"), "ticker", "sector").agg(
        F.avg("price").alias("avg_price"), F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        F.sum("volume").alias("total_volume"), F.count("*").alias("record_count"),
    ).select("ticker", "sector", F.col("hour.start").alias("window_start"), F.col("hour.end").alias("window_end"),
             "avg_price", "min_price", "max_price", "total_volume", "record_count")


def tick_slices(spark: SparkSession, table: str, columns: T.StructType) -> Slices:
    """The stored messages of :func:`dedup_to_table`; ``columns`` is the stream's schema."""
    return Slices(spark, table, T.StructType([*columns.fields, T.StructField("day", T.DateType())]), "day")


def _not_in(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    old = known.select(*[F.col(k).alias(f"_{k}") for k in keys])
    return rows.join(old, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left_anti")


def dedup_to_table(
    ticks: DataFrame, keys: Sequence[str], table: str, checkpoint: str, ts: str = "ts", delay: str = "2 hours",
    progress_table: str | None = None, merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """One message per key into a table of slices by day and batch; ``tick_slices`` reads it.

    Copies that arrive within ``delay`` of the newest event time are recognised by a state
    store that holds the keys of that time only (``dropDuplicatesWithinWatermark``), without a
    look at the table.  Later ones, which the operator would drop, and messages without a time
    are compared with the table's rows of their own days.  So no message is lost, the result
    does not depend on how the input is cut into batches, and neither state nor lookups grow
    with the history.  ``keys`` must contain the event time; a replay replaces its own slice.

    ``progress_table`` gets a line per batch: newest event time, messages sent, kept by the
    state store, late ones, and those of the late that were new.
    """
    if ts not in keys:
        raise ValueError(f"the keys must contain the event time {ts}")
    columns = ticks.schema
    progress_path = progress_table or f"{table}/progress"
    kept = ticks.filter(F.col(ts).isNotNull()).withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
    both = kept.withColumn("_kept", F.lit(True)).unionByName(ticks.withColumn("_kept", F.lit(False)))

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        slices = tick_slices(spark, table, columns)
        with workspace.scratch(spark):
            # The state store is asked once per batch.
            rows = workspace.materialized(batch.withColumn("day", F.to_date(ts)), "batch")
            sent = rows.filter(~F.col("_kept"))
            seen = _progress(spark, progress_path).filter(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
            # The watermark is the newest event time of earlier batches less the delay; a
            # second more costs a few lookups and misses no row that the operator dropped.
            behind = F.col(ts).isNull()
            if seen is not None:
                behind |= F.col(ts) <= F.lit(seen) - F.expr(f"INTERVAL {delay}") + F.expr("INTERVAL 1 SECOND")
            late = top_k_per_group(sent.filter(behind), keys, [F.xxhash64(*columns.fieldNames())], 1, "_n").drop("_n")
            late = workspace.materialized(late, "late")
            days = [r[0] for r in late.select("day").distinct().limit(sinks.MOST_PARTITIONS + 1).collect()]
            if len(days) > sinks.MOST_PARTITIONS:
                raise ValueError(f"the late rows of a batch have more than {sinks.MOST_PARTITIONS} days")
            on_time = rows.filter("_kept")
            found = on_time
            if days:
                new = _not_in(_not_in(late, on_time, keys), slices.rows(before=batch_id, days=days), keys)
                found = workspace.materialized(on_time.unionByName(new), "found")
            slices.put(found, batch_id)
            line = sent.agg(F.max(ts).cast("timestamp").alias("newest"), F.count(F.lit(1)).alias("sent")).select(
                "*", on_time.agg(F.count(F.lit(1)).alias("n")).scalar().alias("kept"),
                late.agg(F.count(F.lit(1)).alias("n")).scalar().alias("late"),
                (found.agg(F.count(F.lit(1)).alias("n")).scalar() - on_time.agg(F.count(F.lit(1)).alias("n")).scalar()).alias("late_new"),
                F.lit(batch_id).cast("bigint").alias("batch_id"))
            sinks.replace_slices(line, progress_path, ["batch_id"])
        _merge_now_and_then(slices, batch_id, merge_every)

    return run_to_end(both.writeStream, checkpoint, store)


_DEDUP_PROGRESS = _columns(newest="timestamp", sent="long", kept="long", late="long", late_new="long", batch_id="long")


def _progress(spark: SparkSession, path: str) -> DataFrame:
    found = sinks.read_or_none(spark, path, _DEDUP_PROGRESS)
    return spark.createDataFrame([], _DEDUP_PROGRESS) if found is None else found


PROGRESS_LINE = "batch_id bigint, processed bigint, error_count bigint"


def store_and_count(
    messages: DataFrame, schema: T.StructType, table: str, progress_table: str, checkpoint: str,
    required: Sequence[str] = ("ticker",),
) -> StreamingQuery:
    """Good rows into a table, and per batch the messages processed and rejected.

    The counts are observed while the batch is written, so they cost no second
    pass, and they are kept in a table, one slice per batch: a replayed batch
    replaces its own count.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        counts = Observation("ingest")
        rows = checked(batch, schema, required).observe(
            counts,
            F.count(F.lit(1)).alias("processed"),
            F.count_if(F.col("error_msg").isNotNull()).alias("error_count"),
        )
        sinks.replace_slices(good_rows(rows).withColumn("batch_id", F.lit(batch_id)), table, ["batch_id"])
        seen = counts.get
        line = batch.sparkSession.createDataFrame([(batch_id, seen["processed"], seen["error_count"])], PROGRESS_LINE)
        sinks.replace_slices(line, progress_table, ["batch_id"])

    return run_to_end(messages.writeStream, checkpoint, store)


def progress_totals(progress: DataFrame) -> DataFrame:
    return progress.agg(F.sum("processed").alias("processed"), F.sum("error_count").alias("error_count"))


class ProgressListener(StreamingQueryListener):
    """Writes what the observed counts of a query say about each batch to a table, beside the query.

    Spark reports them after the batch, on a thread of its own, so the stream does not wait
    for the table.  A line is a slice by batch: reported twice, it is there once.
    """

    def __init__(self, spark: SparkSession, name: str, table: str):
        self._spark, self._name, self._table = spark, name, table
        self._ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self._name)
        if seen is None or not event.progress.numInputRows:
            return
        line = self._spark.createDataFrame(
            [(event.progress.batchId, seen["processed"], seen["error_count"])], PROGRESS_LINE)
        sinks.replace_slices(line, self._table, ["batch_id"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.set()  # events come in order, so all progress is written

    def wait(self, seconds: float = 60) -> None:
        """Until the last line is written."""
        if not self._ended.wait(seconds):
            raise TimeoutError("the end of the query was not reported")


def store_and_report(
    messages: DataFrame, schema: T.StructType, table: str, progress_table: str, checkpoint: str,
    required: Sequence[str] = ("ticker",),
) -> StreamingQuery:
    """As :func:`store_and_count`, with the counts reported by a listener instead of the writing batch.

    ``store_and_count`` is for counts that must be there with the rows, this for dashboards: a
    driver that stops between batch and report loses the line of that batch, not its rows.
    """
    spark = messages.sparkSession
    name = f"ingest-{uuid.uuid4().hex}"
    rows = checked(messages, schema, required).observe(
        name, F.count(F.lit(1)).alias("processed"), F.count_if(F.col("error_msg").isNotNull()).alias("error_count"))

    def store(batch: DataFrame, batch_id: int) -> None:
        sinks.replace_slices(good_rows(batch).withColumn("batch_id", F.lit(batch_id)), table, ["batch_id"])

    listener = ProgressListener(spark, name, progress_table)
    spark.streams.addListener(listener)
    try:
        query = run_to_end(rows.writeStream, checkpoint, store)
        listener.wait()
    finally:
        spark.streams.removeListener(listener)
    return query
