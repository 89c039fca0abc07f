"""Each fact table is read as often as stated, counting the reads behind what a job writes first."""

import random
import re
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from fundtide import catalog
from fundtide.operators import joins, ranking, returns
from fundtide.operators.positions import Book
from fundtide.sources import market, tables
from tests.test_plans import SF, plan


def scans(text):
    return Counter(re.findall(r"InMemoryFileIndex\(1 paths\)\[[^\]]*/(lineitem|events|part)\.parquet\]", text))


@pytest.fixture()
def fact_scans(spark, monkeypatch):
    """Planned scans of a query, of all that it writes on the way included; stored bars are there already."""
    texts = []
    write = DataFrameWriter.parquet

    def recorded(self, *args, **options):
        texts.append(plan(self._df))
        return write(self, *args, **options)

    def count(key):
        catalog.queries()[key](spark, SF)  # makes the stored bars
        monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
        texts.clear()
        df = catalog.queries()[key](spark, SF)
        monkeypatch.setattr(DataFrameWriter, "parquet", write)
        return sum((scans(t) for t in [*texts, plan(df)]), Counter())

    return count


@pytest.mark.parametrize("key, facts", [
    ("latest_snapshot_join", {"lineitem": 1, "part": 1}),
    ("latest_holding_pair", {"lineitem": 1, "part": 1}),
    ("top_k_by_weight", {"lineitem": 1, "part": 1}),
    ("mcap_rank_nulls_last", {"lineitem": 1}),
    ("top_holdings_by_mcap", {"lineitem": 1}),
    ("fund_top_holdings", {"events": 1}),
    ("holdings_meta_metrics", {"events": 1}),
    ("holdings_left_mcap_returns", {"events": 1}),
    ("top5_per_fund", {"events": 1}),
    ("trending_top_holdings_board", {"lineitem": 1, "part": 1}),
    ("conditional_holdings_plan", {"lineitem": 2, "part": 1}),
    ("gate_allocation_ready", {"lineitem": 2}),
    ("join_latest_metadata", {"lineitem": 1, "part": 1}),
    ("period_trend_board", {}),
    ("filter_trailing_days", {}),
    ("stock_metrics", {}),
    ("sector_summary_7d", {}),
    ("sector_sum_change", {}),
    ("mtd_top_equal_weight", {}),
    ("sector_leader_mtd", {}),
])
def test_reads_of_the_facts(fact_scans, key, facts):
    assert fact_scans(key) == facts


def test_stored_bars_follow_their_facts(spark, folder, monkeypatch):
    made = []
    create = market.StoredBars.create
    monkeypatch.setattr(market.StoredBars, "create", lambda self, bars: made.append(1) or create(self, bars))
    home = folder("market")

    def write(days):
        rows = [(i, i % 3, "view", f"2026-01-{1 + i % days:02d} 10:00:00", float(i)) for i in range(60)]
        spark.createDataFrame(rows, "event_id long, user_id long, event_type string, at string, value double").select(
            "*", F.to_timestamp_ntz("at").alias("ts")).drop("at").coalesce(1).write.mode("overwrite").parquet(f"{home}/events.parquet")

    for days, times in ((5, 1), (9, 2)):
        write(days)
        for _ in range(2):
            m = market.event_market(spark, home)
            assert m.stored_clock.newest == date(2026, 1, days)
            got = m.stored_stock_prices.drop("trade_month").collect()
            assert sorted(map(tuple, got)) == sorted(map(tuple, m.stock_prices.select(*got[0].__fields__).collect()))
            assert len(made) == times
    with pytest.raises(ValueError, match="no stored history"):
        market.event_market(spark, home, last_days=3).stored_stock_prices


def test_book_of_trades(spark):
    rng = random.Random(2)
    rows = [(rng.choice("AB"), rng.choice(["x", "y", "z", None]), date(2026, 1, rng.randint(1, 3)), rng.randint(0, 9)) for _ in range(200)]
    trades = spark.createDataFrame(rows, "fund string, stock string, day date, cents long")
    book = Book.of(trades, "fund", "stock", "day", "cents", [F.count("*").alias("n")])
    want, total = Counter(), Counter()
    for f, s, d, c in rows:
        want[f, s, d] += c
        total[f, d] += c
    assert {(r["fund"], r["stock"], r["day"]): r["cents"] for r in book.positions.collect()} == want
    assert {(r["fund"], r["day"]): r["total"] for r in book.totals.collect()} == total
    newest = {f: max(d for g, d in total if g == f) for f in "AB"}
    shares = {(r["fund"], r["stock"]): r["holding_percent"] for r in book.with_share("cents", newest=True).collect()}
    assert shares == {(f, s): pytest.approx(100 * c / total[f, d]) for (f, s, d), c in want.items() if newest[f] == d}
    renamed = book.positions.select(F.col("fund").alias("etf_ticker"), "stock", F.col("day").alias("as_of_date"), "cents")
    assert joins.latest_snapshot(renamed).count() == len(shares)


def test_top_by_weight_reads_once_and_tells_percents(spark):
    rows = [("A", "a", 1.0, 3), ("A", "b", None, 1), ("A", "c", 5.0, 2), ("A", "", 9.0, 0),
            ("B", "x", None, 2), ("B", "y", None, 1), ("B", "z", None, 3), (None, "n", 1.0, 1)]
    holdings = spark.createDataFrame(rows, "etf_ticker string, holding_ticker string, holding_percent double, arrival int")
    got = [(r["etf_ticker"], r["holding_ticker"], r["rank"]) for r in ranking.top_by_weight(holdings, 2, arrival="arrival").collect()]
    assert sorted(got, key=repr) == sorted(
        [("A", "c", 1), ("A", "a", 2), ("B", "y", 1), ("B", "x", 2), (None, "n", 1)], key=repr)


def test_windows_inside_each_other_equal_windows_one_by_one(spark):
    rng = random.Random(3)
    end = date(2026, 2, 20)
    rows = [(t, end - timedelta(days=d), rng.choice([None, 0.0, 1.0, 2.0, 5.0])) for t in "ABCDE" for d in range(-1, 40) if rng.random() < 0.4]
    bars = spark.createDataFrame(rows, "ticker string, trade_date date, close_price double")
    columns = ["ticker", "period_days", "start_price", "end_price", "start_date", "end_date", "day_count", "return_pct"]
    one_by_one = returns.point_return(returns.calendar_periods(bars, end, (20, 5, 10), 3), ("ticker", "period_days")).select(*columns)
    at_once = returns.calendar_returns(bars, end, (20, 5, 10), 3).select(*columns)
    assert sorted(map(tuple, at_once.collect())) == sorted(map(tuple, one_by_one.collect()))


@pytest.mark.parametrize("days, parts", [(1, 4), (2, 4), (10, 3), (365, 12), (7, 7), (7, 1)])
def test_ranges_of_a_database_table_hold_each_row_once(days, parts):
    import duckdb

    low = date(2026, 1, 30)
    found = tables.range_predicates("d", low, low + timedelta(days=days - 1), parts)
    assert len(found) == min(parts, days) + 1
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT DATE '2026-01-01' + CAST(i AS INTEGER) AS d FROM range(500) r(i) UNION ALL SELECT NULL")
    counts = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in found]
    assert sum(counts) == 501 and counts[-1] == 1
    inside = [con.execute(f"SELECT count(*) FROM t WHERE {p} AND d BETWEEN DATE '{low}' AND DATE '{low + timedelta(days=days - 1)}'").fetchone()[0]
              for p in found[:-1]]
    assert max(inside) - min(inside) <= 1
    assert tables.range_predicates("d", None, None, parts) == ["1 = 1"]
