"""Streams that run for long: bounded files, bounded state, nothing lost, and the same after a replay."""

import os
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundtide import schemas
from fundtide.sources import tables
from fundtide.sources.slices import Slices
from fundtide.streaming import ingest

SCHEMA = T.StructType().add("name", "string").add("n", "long").add("day", "date")


def files(path):
    return sum(name.endswith(".parquet") for _, _, names in os.walk(path) for name in names)


def summed(rows):
    return rows.groupBy("name", "day").agg(F.sum("n").alias("n"))


def put(spark, slices, batch, *rows):
    slices.put(spark.createDataFrame([(n, c, d) for n, c, d in rows], SCHEMA), batch)


def totals(slices):
    return {(r["name"], r["day"]): r["n"] for r in summed(slices.rows()).collect()}


DAYS = [date(2026, 1, 1), date(2026, 1, 2), None]


def test_files_stay_few_over_fifty_batches(spark, folder):
    path = folder("slices")
    slices, want = Slices(spark, path, SCHEMA, "day", summed), Counter()
    for batch in range(50):
        rows = [(name, batch, DAYS[(batch + k) % 3]) for k, name in enumerate("ab")]
        put(spark, slices, batch, *rows)
        for name, n, day in rows:
            want[name, day] += n
        if batch and batch % 10 == 0:
            slices.compact(batch)
            assert totals(slices) == want
    # Up to ten batches of two days each since the last merge, twice, and two versions of three days.
    assert files(path) <= 2 * 10 * 2 + 2 * 3 + 5
    assert slices.rows().filter(F.col("day") == DAYS[0]).count() < 20


def test_a_replay_changes_nothing(spark, folder):
    slices = Slices(spark, folder("slices"), SCHEMA, "day", summed)
    batches = [[("a", 1, DAYS[0])], [("a", 2, DAYS[1])], [("a", 4, DAYS[0]), ("b", 8, None)]]
    for batch, rows in enumerate(batches):
        for _ in range(2):
            put(spark, slices, batch, *rows)
    want = {("a", DAYS[0]): 5, ("a", DAYS[1]): 2, ("b", None): 8}
    assert totals(slices) == want
    for _ in range(2):
        slices.compact(2)
        assert totals(slices) == want and slices.covered() == 1
    put(spark, slices, 1, *batches[1])  # already merged
    put(spark, slices, 2, *batches[2])
    assert totals(slices) == want
    assert {(r["name"], r["n"]) for r in slices.rows(before=2, days=[DAYS[0]]).collect()} == {("a", 1)}
    slices.compact(3)
    assert totals(slices) == want
    put(spark, slices, 3, ("a", 1, DAYS[0]))
    assert totals(slices) == want | {("a", DAYS[0]): 6}


def test_a_merge_that_stopped_before_its_mark(spark, folder, monkeypatch):
    slices = Slices(spark, folder("slices"), SCHEMA, "day", summed)
    for batch in range(3):
        put(spark, slices, batch, ("a", 1, DAYS[0]))
    slices.compact(2)
    put(spark, slices, 3, ("a", 1, DAYS[0]))
    from fundtide.sources import sinks

    write = sinks.replace_slices

    def stops(df, path, partition_by):
        if path.endswith("/marks"):
            raise OSError("the driver is gone")
        write(df, path, partition_by)

    monkeypatch.setattr(sinks, "replace_slices", stops)
    with pytest.raises(OSError):
        slices.compact(4)
    assert totals(slices) == {("a", DAYS[0]): 4} and slices.covered() == 1
    monkeypatch.undo()
    slices.compact(4)
    assert totals(slices) == {("a", DAYS[0]): 4} and slices.covered() == 3


TICKS = "ticker string, ts timestamp, price double"


def deliver(spark, topic, *rows):
    """One file, so one batch, of (ticker, hour, price); hour None for a message without time."""
    frame = spark.createDataFrame(list(rows), "ticker string, hour int, price double").coalesce(1)
    start = F.expr("timestamp'2026-01-01 00:00:00'")
    frame.select("ticker", (start + F.make_dt_interval(hours=F.col("hour"))).alias("ts"), "price").write.mode("append").parquet(topic)


def run_dedup(spark, topic, table, progress, offsets, **more):
    stream = spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(topic)
    query = ingest.dedup_to_table(stream, ["ticker", "ts"], table, offsets, progress_table=progress, **more)
    return query, ingest.tick_slices(spark, table, stream.schema)


def test_state_holds_the_delay_and_late_rows_are_looked_up(spark, folder):
    topic, table, progress, offsets = (folder(n) for n in ("topic", "ticks", "progress", "offsets"))
    batches = [
        [("A", 100, 1.0), ("B", 100, 2.0), ("A", 100, 1.0), ("C", 40, 3.0)],
        [("A", 101, 4.0), ("A", 100, 1.0), ("A", 10, 5.0), ("A", 10, 5.0), ("C", 40, 3.0), (None, 101, 9.0)],
        [("A", 200, 6.0), ("A", 10, 5.0), ("B", 30, 7.0), ("A", None, 8.0), ("A", None, 8.0), (None, 101, 9.0)],
        [("A", 201, 6.0), ("B", 100, 2.0), ("A", None, 8.0), ("C", 40, 3.0)],
    ]
    queries = []
    for rows in batches:
        deliver(spark, topic, *rows)
        query, slices = run_dedup(spark, topic, table, progress, offsets, merge_every=2)
        queries += query.recentProgress
    want = {(t, h, p) for rows in batches for t, h, p in rows}
    got = [(r["ticker"], r["hour"], r["price"]) for r in slices.rows().select(
        "ticker", ((F.unix_timestamp("ts") - F.unix_timestamp(F.expr("timestamp'2026-01-01 00:00:00'"))) / 3600).cast("int").alias("hour"),
        "price").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    lines = [r for r in spark.read.parquet(progress).orderBy("batch_id").collect() if r["sent"]]
    assert [r["sent"] for r in lines] == [len(rows) for rows in batches]
    assert sum(r["kept"] + r["late_new"] for r in lines) == len(want)
    # Keys of the last hours only, whatever has gone through.
    state = [o["numRowsTotal"] for p in queries for o in (p["stateOperators"] if isinstance(p, dict) else
                                                           [{"numRowsTotal": s.numRowsTotal} for s in p.stateOperators])]
    assert state and state[-1] <= 2 and max(state) <= 5


def test_any_cut_into_batches(spark, folder):
    rows = [("ABC"[i % 3], (i * 37) % 300, float(i % 3)) for i in range(60)]
    results = []
    for size in (5, 60):
        topic = folder("topic")
        for at in range(0, 60, size):
            deliver(spark, topic, *rows[at:at + size], *rows[max(0, at - 3):at])
        _, slices = run_dedup(spark, topic, folder("ticks"), folder("progress"), folder("offsets"), merge_every=3)
        results.append(sorted((r["ticker"], r["ts"]) for r in slices.rows().collect()))
    assert results[0] == results[1] and len(results[0]) == len({(t, h) for t, h, _ in rows})


def test_merged_hours_are_the_same(spark, folder):
    rows = [("A", h % 50, float(h)) for h in range(40)]
    results = []
    for merge_every in (2, 100):
        topic, table = folder("topic"), folder("hours")
        for row in rows[:8]:
            deliver(spark, topic, row)
        schema = "ticker string, sector string, ts timestamp, price double, volume bigint"
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(topic)
        ingest.hourly_to_table(stream, table, folder("offsets"), merge_every=merge_every)
        results.append(sorted(map(tuple, ingest.latest_hours(ingest.hour_slices(spark, table)).collect()), key=repr))
        assert (ingest.hour_slices(spark, table).covered() >= 0) == (merge_every == 2)
    assert results[0] == results[1] and len(results[0]) == 8


def test_listener_and_observed_counts_agree(spark, folder):
    topic = folder("topic")
    good, bad, nameless = '{"ticker":"A","current_price":1.0}', '{ticker', '{"current_price":1.0}'
    for values in ([good, bad], [good, good, nameless], [bad]):
        spark.createDataFrame([("k", v) for v in values], schemas.TOPIC).coalesce(1).write.mode("append").parquet(topic)
    found = []
    for run in (ingest.store_and_count, ingest.store_and_report):
        table, progress = folder("good"), folder("progress")
        run(tables.topic_stream(spark, topic, files_per_batch=1), schemas.TICK_MESSAGE, table, progress, folder("offsets"))
        found.append(sorted((r["batch_id"], r["processed"], r["error_count"]) for r in spark.read.parquet(progress).collect()))
        assert spark.read.parquet(table).count() == 3
    assert found[0] == found[1] and sum(r[1] for r in found[0]) == 6 and sum(r[2] for r in found[0]) == 3
