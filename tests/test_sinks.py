"""Writes: slices, keyed upserts, topics, and streaming jobs run twice."""

import os
from datetime import date

from pyspark.sql import functions as F

from fundtide import schemas
from fundtide.sources import sinks, tables, workspace
from fundtide.streaming import ingest


def _bars(spark, *rows):
    df = spark.createDataFrame(list(rows), "ticker string, trade_date date, close_price double")
    return ingest.with_month(df)


def _stored(spark, path):
    return sorted((r.ticker, str(r.trade_date), r.close_price) for r in spark.read.parquet(path).collect())


def _files(path):
    return {
        os.path.join(base, name): os.path.getmtime(os.path.join(base, name))
        for base, _, names in os.walk(path) for name in names if name.endswith(".parquet")
    }


def test_upsert_touches_only_the_months_it_brings(spark, folder):
    path = folder("bars")
    jan, feb = date(2026, 1, 5), date(2026, 2, 5)
    sinks.upsert_rows(_bars(spark, ("A", jan, 1.0), ("A", feb, 2.0)), path, ["ticker", "trade_date"], "trade_month")
    january = {f: t for f, t in _files(path).items() if "2026-01" in f}
    late = _bars(spark, ("A", feb, 3.0), ("B", feb, 4.0))
    for _ in range(2):
        sinks.upsert_rows(late, path, ["ticker", "trade_date"], "trade_month")
        assert _stored(spark, path) == [
            ("A", "2026-01-05", 1.0), ("A", "2026-02-05", 3.0), ("B", "2026-02-05", 4.0)
        ]
    assert {f: t for f, t in _files(path).items() if "2026-01" in f} == january


def test_replace_slice_leaves_others_alone(spark, folder):
    path = folder("slices")
    df = spark.createDataFrame([(5, "A"), (10, "B")], "period int, ticker string")
    sinks.replace_slices(df, path, ["period"])
    sinks.replace_slices(spark.createDataFrame([(10, "C")], "period int, ticker string"), path, ["period"])
    assert sorted((r.period, r.ticker) for r in spark.read.parquet(path).collect()) == [(5, "A"), (10, "C")]


def test_read_or_none(spark, folder):
    assert sinks.read_or_none(spark, folder("nothing")) is None


def test_files_go_to_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    expected = (named or spark.sparkContext.getCheckpointDir()).rstrip("/")
    assert workspace.new_folder(spark, "x").startswith(expected + "/fundtide/x-")


def _topic(spark, folder, *values):
    path = folder("topic")
    rows = spark.createDataFrame([("k", v) for v in values], schemas.TOPIC)
    sinks.write_topic(rows, path)
    return path


_BAR = '{"ticker":"%s","trade_date":"2026-01-%02d","close_price":%s,"timestamp":"%s"}'


def test_stream_splits_and_upserts(spark, folder):
    table, dead, offsets = folder("bars"), folder("dead"), folder("offsets")
    topic = _topic(
        spark, folder,
        _BAR % ("AAPL", 5, 1.0, "T1"), _BAR % ("AAPL", 5, 2.0, "T2"),
        '{ticker:"AAPL", close_price:185.42}', '{"close_price":1.0,"trade_date":"2026-01-05"}',
    )
    ingest.upsert_bars(tables.topic_stream(spark, topic), schemas.STOCK_BAR_MESSAGE, table, dead, offsets)
    assert _stored(spark, table) == [("AAPL", "2026-01-05", 2.0)]
    letters = sorted((r.error_msg, r.raw_value[:12]) for r in spark.read.parquet(dead).collect())
    assert letters == [("malformed message", '{ticker:"AAP'), ("missing ticker", '{"close_pric')]

    # More messages arrive; the checkpoint goes on from where it stopped.
    sinks.write_topic(
        spark.createDataFrame([("k", _BAR % ("AAPL", 5, 3.0, "T0")), ("k", _BAR % ("MSFT", 6, 9.0, "T1"))], schemas.TOPIC),
        topic,
    )
    ingest.upsert_bars(tables.topic_stream(spark, topic), schemas.STOCK_BAR_MESSAGE, table, dead, offsets)
    assert _stored(spark, table) == [("AAPL", "2026-01-05", 3.0), ("MSFT", "2026-01-06", 9.0)]

    # A replay of everything from a new checkpoint ends in the same keys.
    ingest.upsert_bars(tables.topic_stream(spark, topic), schemas.STOCK_BAR_MESSAGE, table, dead, folder("offsets"))
    assert [r[:2] for r in _stored(spark, table)] == [("AAPL", "2026-01-05"), ("MSFT", "2026-01-06")]


def test_valid_and_malformed_json(spark):
    good = ('{"ticker":"AAPL","sector":"Technology","timestamp":"2026-01-25T10:30:00",'
            '"current_price":185.42,"high":186.0,"low":185.0,"volume":1250000}')
    df = spark.createDataFrame([(good,), ('{ticker:"AAPL", current_price:185.42}',)], "value string")
    rows = ingest.checked(df, schemas.TICK_MESSAGE)
    (kept,) = ingest.good_rows(rows).collect()
    assert (kept.ticker, kept.current_price, kept.volume) == ("AAPL", 185.42, 1250000)
    (letter,) = ingest.dead_letters(rows).collect()
    assert letter.error_msg == "malformed message" and letter.raw_value.startswith("{ticker")


def test_holdings_message_explodes_with_defaults(spark):
    text = ('{"etf_ticker":"XLK","timestamp":"2026-01-25T11:00:00","holdings":['
            '{"holding_ticker":"AAPL","holding_name":"Apple","holding_percent":5.0,"as_of_date":"2026-01-24"},'
            '{"holding_name":"Microsoft Corporation"}]}')
    df = spark.createDataFrame([(text,)], "value string")
    got = ingest.holding_rows(ingest.good_rows(ingest.checked(df, schemas.HOLDINGS_MESSAGE, ["etf_ticker"]))).collect()
    assert [(r.holding_ticker, str(r.as_of_date)) for r in got] == [("AAPL", "2026-01-24"), ("Microsoft ", "2026-01-25")]


def test_hours_spread_over_batches(spark, folder):
    topic, table, offsets = folder("ticks"), folder("hours"), folder("offsets")
    schema = "ticker string, sector string, ts timestamp, price double, volume bigint"
    for minute, price in ((15, 10.0), (45, 20.0)):
        spark.sql(
            f"SELECT 'A' AS ticker, 'S' AS sector, timestamp'2026-01-25 10:{minute}:00' AS ts, "
            f"{price}D AS price, 5L AS volume"
        ).write.mode("append").parquet(topic)
        ingest.hourly_to_table(spark.readStream.schema(schema).parquet(topic), table, offsets)
    (row,) = ingest.latest_hours(ingest.hour_slices(spark, table)).collect()
    assert (row.avg_price, row.total_volume, row.record_count) == (15.0, 10, 2)


def test_message_round_trip(spark, folder):
    path = folder("topic")
    sinks.write_topic(sinks.messages(spark.createDataFrame([("A", 1)], "ticker string, v int"), "ticker"), path)
    (row,) = tables.topic_batch(spark, path).select("key", F.get_json_object("value", "$.v").alias("v")).collect()
    assert (row.key, row.v) == ("A", "1")


def test_upsert_keeps_rows_without_partition(spark, folder):
    """A holdings message without any date goes to the NULL partition, and stays there."""
    table, dead, offsets = folder("holdings"), folder("dead"), folder("offsets")
    topic = folder("topic")
    for fund, name in (("A", "X"), ("B", "Y")):
        body = '{"etf_ticker":"%s","holdings":[{"holding_ticker":"%s"}]}' % (fund, name)
        sinks.write_topic(spark.createDataFrame([("k", body)], schemas.TOPIC), topic)
        ingest.upsert_holdings(tables.topic_stream(spark, topic), schemas.HOLDINGS_MESSAGE, table, dead, offsets)
    assert sorted((r.etf_ticker, r.holding_ticker) for r in spark.read.parquet(table).collect()) == [("A", "X"), ("B", "Y")]


def test_upsert_reads_only_the_months_it_brings(spark, folder):
    path = folder("bars")
    rows = [("A", date(2026, m, 5), 1.0) for m in range(1, 11)]
    sinks.upsert_rows(_bars(spark, *rows), path, ["ticker", "trade_date"], "trade_month")
    for months, files in (([date(2026, 4, 1)], 1), ([date(2026, 4, 1), date(2026, 7, 1)], 2), ([None], 0)):
        part = sinks.only_partitions(spark.read.parquet(path), "trade_month", months)
        part.collect()
        scan = part._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.metrics().apply("numFiles").value() == files
    sinks.upsert_rows(_bars(spark, ("A", date(2026, 4, 5), 2.0)), path, ["ticker", "trade_date"], "trade_month")
    assert ("A", "2026-04-05", 2.0) in _stored(spark, path) and len(_stored(spark, path)) == 10


def test_holdings_rejects_are_kept_and_counted(spark, folder):
    table, dead, offsets = folder("holdings"), folder("dead"), folder("offsets")
    topic = _topic(
        spark, folder,
        '{"etf_ticker":"A","timestamp":"2026-01-25T11:00:00","holdings":[{"holding_ticker":"X"}]}',
        '{etf_ticker:"A"}', '{"holdings":[{"holding_ticker":"X"}]}', '{"etf_ticker":"A"}', '{"etf_ticker":"A","holdings":[]}',
    )
    ingest.upsert_holdings(tables.topic_stream(spark, topic), schemas.HOLDINGS_MESSAGE, table, dead, offsets)
    assert spark.read.parquet(table).count() == 1
    assert sorted(r.error_msg for r in spark.read.parquet(dead).collect()) == [
        "malformed message", "missing etf_ticker", "missing holdings", "missing holdings"]


TICKS = [("A", 50, 1.0), ("A", 10, 2.0), ("B", 55, 3.0), ("A", 5, 4.0), ("B", 1, 5.0), ("A", 10, 2.0)]


def _tick_files(spark, topic):
    """One file per tick, hours apart and in disorder."""
    for ticker, hour, price in TICKS:
        spark.sql(
            f"SELECT '{ticker}' AS ticker, 'S' AS sector, timestamp'2026-01-01 00:00:00' + INTERVAL {hour} HOURS AS ts, "
            f"{price}D AS price, 1L AS volume").write.mode("append").parquet(topic)


def test_no_tick_is_late(spark, folder):
    """One batch or one per file: the same hours and the same unique ticks, and none is lost."""
    schema = "ticker string, sector string, ts timestamp, price double, volume bigint"
    topic = folder("ticks")
    _tick_files(spark, topic)
    hours, unique = [], []
    for files in (1, 100):
        stream = lambda n=files: spark.readStream.schema(schema).option("maxFilesPerTrigger", n).parquet(topic)
        table = folder("hours")
        ingest.hourly_to_table(stream(), table, folder("offsets"))
        hours.append(sorted(tuple(r) for r in ingest.latest_hours(ingest.hour_slices(spark, table)).collect()))
        table = folder("unique")
        ingest.dedup_to_table(stream(), ["ticker", "ts"], table, folder("offsets"))
        unique.append(sorted((r.ticker, r.ts, r.price) for r in ingest.tick_slices(spark, table, stream().schema).rows().collect()))
    assert hours[0] == hours[1] and sum(r[-1] for r in hours[0]) == len(TICKS)
    assert unique[0] == unique[1] and len(unique[0]) == 5


def test_open_hours_have_a_watermark(spark, folder):
    topic = folder("ticks")
    _tick_files(spark, topic)
    frame = spark.readStream.schema("ticker string, sector string, ts timestamp, price double, volume bigint").parquet(topic)
    assert "EventTimeWatermark" in ingest.open_hours(frame, "1 hour")._jdf.queryExecution().analyzed().toString()


def test_scratch_folders_go_with_their_block(spark):
    with workspace.scratch(spark):
        rows = workspace.materialized(spark.range(5), "step")
        path = workspace.new_folder(spark, "other")
        assert rows.count() == 5
    left = rows.inputFiles()
    assert not any(os.path.exists(f.removeprefix("file://")) for f in left) and not os.path.exists(path)
    try:
        workspace.remove(spark, "/tmp/elsewhere")
        raise AssertionError("removed a folder that is not its own")
    except ValueError:
        pass


def test_no_private_folder_on_a_cluster():
    import pytest

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(RuntimeError):
        workspace.shared_folder(Session())
