"""Stored bars: the change kept on writing equals the change computed from all bars, and reading stays in its months."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from fundtide.functions.dates import Clock
from fundtide.operators.windows import daily_change, month_to_date, since
from fundtide.sources.stored_bars import StoredBars

START = date(2025, 11, 3)


def frame(spark, rows):
    return spark.createDataFrame(rows, "ticker string, trade_date date, close_price double")


def table(spark, folder, rows):
    bars = frame(spark, rows)
    stored = StoredBars(spark, folder("stored"), bars.schema)
    stored.create(bars)
    return stored


def check(spark, stored, rows):
    """``rows`` maps (ticker, day) to the close that must be stored."""
    want = daily_change(frame(spark, [(t, d, c) for (t, d), c in rows.items()]))
    key = lambda r: (r["ticker"], r["trade_date"])
    columns = ["ticker", "trade_date", "close_price", "price_change_percent"]
    got = stored.bars().select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*columns).collect()))
    assert {key(r): r["trade_month"] for r in stored.bars().collect()} == {(t, d): d.replace(day=1) for t, d in rows}
    edges = {(r["ticker"], r["trade_month"]): r["last_close"] for r in stored.edges().collect()}
    last = {}
    for (t, d), c in sorted(rows.items(), key=lambda x: x[0][1]):
        last[t, d.replace(day=1)] = c
    assert edges == last


def test_late_and_corrected_bars_repair_their_successors(spark, folder):
    rows = {("A", date(2025, 11, 3)): 10.0, ("A", date(2026, 2, 2)): 20.0, ("A", date(2026, 2, 3)): 30.0, ("B", date(2026, 2, 2)): 5.0}
    stored = table(spark, folder, [(t, d, c) for (t, d), c in rows.items()])
    check(spark, stored, rows)
    for late in ({("A", date(2025, 12, 24)): 40.0},  # a month without bars; the successor is two months on
                 {("A", date(2025, 11, 3)): 16.0},  # corrected
                 {("A", date(2025, 10, 1)): 8.0, ("C", date(2026, 1, 5)): 1.0},  # before all, and a new ticker
                 {("A", date(2025, 12, 24)): 0.0},  # no change against zero
                 {("B", date(2026, 3, 2)): 6.0, ("A", date(2026, 3, 2)): 3.0}):  # the usual day
        rows.update(late)
        for _ in range(2):  # a second run changes nothing
            stored.upsert(frame(spark, [(t, d, c) for (t, d), c in late.items()]))
            check(spark, stored, rows)


def test_any_order_of_arrival(spark, folder):
    rng = random.Random(5)
    stored = table(spark, folder, [("A", START, 1.0)])
    rows = {("A", START): 1.0}
    for _ in range(5):
        batch = {(rng.choice("ABC"), START + timedelta(days=rng.randrange(-200, 200))): float(rng.randrange(1, 50)) for _ in range(12)}
        rows.update(batch)
        stored.upsert(frame(spark, [(t, d, c) for (t, d), c in batch.items()]))
        check(spark, stored, rows)


def test_versions_of_a_bar_and_bad_rows(spark, folder):
    stored = StoredBars(spark, folder("stored"), frame(spark, []).schema)
    stored.upsert(frame(spark, []))
    stored.upsert(frame(spark, [("A", START, 1.0), ("A", START, 3.0), ("A", START, 2.0), ("B", START, None)]), [F.col("close_price").desc()])
    rows = {("A", START): 3.0, ("B", START): None}
    got = {(r["ticker"], r["trade_date"]): (r["close_price"], r["price_change_percent"]) for r in stored.bars().collect()}
    assert got == {k: (v, 0.0) for k, v in rows.items()}
    with pytest.raises(ValueError, match="no trade_date"):
        stored.upsert(frame(spark, [("A", None, 1.0)]))


def test_only_the_months_touched_are_rewritten(spark, folder):
    days = [START + timedelta(days=i) for i in range(300)]
    stored = table(spark, folder, [(t, d, float(i + 1)) for t in "AB" for i, d in enumerate(days)])

    def files():
        return {r[0]: r[1] for r in stored.bars().groupBy(F.col("_metadata.file_path")).agg(
            F.max("_metadata.file_modification_time")).collect()}

    before = files()
    stored.upsert(frame(spark, [("A", START + timedelta(days=70), 9.0)]))
    after = files()
    gone = {p.split("trade_month=")[1][:10] for p in set(before) - set(after)}
    assert gone == {"2026-01-01"}  # the next month's first bar follows January's unchanged last one
    stored.upsert(frame(spark, [("A", date(2026, 1, 31), 7.5)]))
    gone = {p.split("trade_month=")[1][:10] for p in set(after) - set(files())}
    assert gone == {"2026-01-01", "2026-02-01"}


def test_readers_open_their_months(spark, folder):
    from tests.test_plans import _scan_rows

    days = [START + timedelta(days=i) for i in range(300)]
    stored = table(spark, folder, [(t, d, float(i + 1)) for t in "AB" for i, d in enumerate(days)])
    bars = stored.bars()
    clock = Clock(bars, F.col("trade_date"))
    assert clock.newest == days[-1]
    assert _scan_rows(since(bars, clock, 7)) <= 2 * 62
    assert _scan_rows(month_to_date(bars, clock)) <= 2 * 31
