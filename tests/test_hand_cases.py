"""Hand-computed cases."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fundtide import schemas, settings
from fundtide.functions import columns as C
from fundtide.operators import boards, filters, joins, portfolio, quality, ranking, returns, sets, windows
from fundtide.plans import jobs


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_five_row_return_is_the_same_both_ways(bars):
    series = bars({"AAPL": [150, 151, 152, 153, 155]})
    for kind in ("range", "point"):
        (row,) = returns.period_returns(series, [5], kind).collect()
        assert row.return_pct == pytest.approx(10 / 3)
        assert row.day_count == 5


def test_range_and_point_differ_on_a_dip(bars):
    series = bars({"X": [10, 12, 9]})
    (ranged,) = returns.period_returns(series, [3], "range").collect()
    (pointed,) = returns.period_returns(series, [3], "point").collect()
    assert ranged.return_pct == pytest.approx(100 / 3)
    assert pointed.return_pct == pytest.approx(-10)


def test_several_periods_in_one_pass(bars):
    series = bars({"AAPL": [150 + 0.5 * i for i in range(1, 26)]})
    got = {r.period_days: r.return_pct for r in returns.period_returns(series, kind="point").collect()}
    assert got[5] == pytest.approx(1.246106, abs=1e-6)
    assert got[10] == pytest.approx(2.848101, abs=1e-6)
    assert got[20] == pytest.approx(6.209150, abs=1e-6)


def test_coverage_rule_drops_short_series(bars):
    series = bars({"LONG": range(1, 15), "SHORT": range(1, 14)})
    assert rows(returns.period_returns(series, [20]), "ticker") == [("LONG",)]


def test_top_three_by_percent_and_missing_left_out(spark):
    held = spark.createDataFrame(
        [("SPY", "MSFT", 5.5), ("SPY", "AAPL", 5.2), ("SPY", "NVDA", 4.8), ("SPY", "TSLA", 2.1), ("SPY", "ZZZ", None)],
        "etf_ticker string, holding_ticker string, holding_percent double",
    )
    assert rows(ranking.top_by_weight(held, 3), "rank", "holding_ticker") == [(1, "MSFT"), (2, "AAPL"), (3, "NVDA")]
    assert rows(ranking.top_by_weight(held, 9), "rank", "holding_ticker")[-1] == (4, "TSLA")


def test_dedup_keeps_three_of_four(spark):
    ticks = spark.createDataFrame(
        [("AAPL", "10:30", 1.0), ("AAPL", "10:30", 1.0), ("AAPL", "10:31", 2.0), ("MSFT", "10:30", 3.0)],
        "ticker string, ts string, price double",
    )
    assert sets.dedup_by_key(ticks, ["ticker", "ts"]).count() == 3


def test_null_filter_and_safe_cast(spark):
    df = spark.createDataFrame(
        [("AAPL", 1.0), ("MSFT", None), ("GOOG", 2.0), (None, 3.0)], "ticker string, price double"
    )
    assert filters.non_null(df, ["ticker", "price"]).count() == 2
    text = spark.createDataFrame([("100.5",), ("not_a_number",)], "v string")
    assert [r[0] for r in text.select(F.col("v").try_cast("double")).collect()] == [100.5, None]


def test_empty_input(spark, bars):
    nothing = bars({"A": [1]}).limit(0)
    assert returns.period_returns(nothing).collect() == []
    assert windows.daily_change(nothing).collect() == []


def test_daily_change_starts_at_zero(bars):
    got = rows(windows.daily_change(bars({"A": [10, 12, 9, 0, 5]})), "trade_date", "price_change_percent")
    assert [round(v, 6) for _, v in got] == [0.0, 20.0, -25.0, -100.0, 0.0]


def _allocations(spark, members):
    """members: {period: [(ticker, return)]}"""
    return spark.createDataFrame(
        [
            (date(2026, 1, 25), p, t, f"{t} Inc", "Tech", 10, float(r), 0.1, f"reason {p}")
            for p, names in members.items() for t, r in names
        ],
        "as_of_date date, period_days int, ticker string, company_name string, sector string, market_cap bigint, "
        "return_pct double, portfolio_weight double, allocation_reason string",
    )


def test_overlap_scores_and_exclusive_classes(spark):
    alloc = _allocations(spark, {
        20: [("ALL", 1), ("A2010", 2), ("A20", 3)],
        10: [("ALL", 4), ("A2010", 5), ("A105", 6), ("A10", 7)],
        5: [("ALL", 8), ("A105", 9), ("A5", 10)],
    })
    got = {r.ticker: r for r in portfolio.period_overlap(alloc).collect()}
    assert {t: r.score for t, r in got.items()} == {
        "ALL": 3.0, "A2010": 2.0, "A20": 1.0, "A105": 2.0, "A10": 0.5, "A5": 0.3
    }
    assert got["ALL"].source_periods == "20d,10d,5d" and got["A105"].source_periods == "10d,5d"
    assert got["ALL"].return_20 == 1 and got["A105"].return_20 == 9 and got["A10"].return_20 == 7
    assert {t for t, r in got.items() if r.is_new} == {"A105", "A10", "A5"}


def test_monthly_rebalance(spark):
    alloc = _allocations(spark, {20: [("A", 1), ("B", 2)], 10: [("A", 3)], 5: [("C", 4)]})
    got = jobs.monthly_rebalance(alloc).collect()
    assert [(r.ticker, r.final_rank, r.valid_until) for r in sorted(got, key=lambda r: r.final_rank)] == [
        ("A", 1, date(2026, 2, 22)), ("B", 2, date(2026, 2, 22)), ("C", 3, date(2026, 2, 22)),
    ]
    assert sum(r.final_weight for r in got) == pytest.approx(1)
    assert jobs.monthly_rebalance(alloc.filter("period_days <> 5")).collect() == []
    assert jobs.monthly_rebalance(alloc, only_last_sunday=True).count() == 3
    earlier = alloc.withColumn("as_of_date", F.lit("2026-01-18").cast("date"))
    assert jobs.monthly_rebalance(earlier, only_last_sunday=True).collect() == []


def _returns(spark, values):
    return spark.createDataFrame(
        [(t, 20, float(r), f"{t} Inc", "Tech", m) for t, r, m in values],
        "ticker string, period_days int, return_pct double, company_name string, sector string, market_cap bigint",
    )


def test_allocation_weights(spark):
    pairs = spark.createDataFrame([("F1", "A"), ("F2", "B"), ("F3", "C"), ("F4", "D")], "etf_ticker string, holding_ticker string")
    funds = spark.createDataFrame([("F1",), ("F2",), ("F3",), ("F4",)], "etf_ticker string")
    day = F.lit("2026-01-25").cast("date")
    stocks = _returns(spark, [("A", 2, 1), ("B", 1, 1), ("C", 1, 1), ("D", 9, 0)])
    out = portfolio.allocate(stocks, pairs, funds, day)
    assert rows(out, "rank", "ticker", "weight") == [(1, "A", 50.0), (2, "B", 25.0), (3, "C", 25.0)]
    assert {r.allocation_reason for r in out.collect()} == {"top1_perf_per_etf_20d_score_perf_x_inv_mcap"}
    stored = portfolio.roll_up_by_stock(out)
    assert rows(stored, "ticker", "portfolio_weight") == [("A", 0.5), ("B", 0.25), ("C", 0.25)]
    flat = portfolio.allocate(_returns(spark, [("A", 0, 1), ("B", 0, 1)]), pairs, funds, day, ranked=False)
    assert rows(flat, "ticker", "weight") == [("A", 50.0), ("B", 50.0)]


def test_one_stock_picked_by_two_funds_keeps_its_whole_weight(spark):
    pairs = spark.createDataFrame([("F1", "A"), ("F2", "A"), ("F3", "B")], "etf_ticker string, holding_ticker string")
    funds = spark.createDataFrame([("F1",), ("F2",), ("F3",)], "etf_ticker string")
    out = portfolio.allocate(
        _returns(spark, [("A", 1, 1), ("B", 2, 1)]), pairs, funds, F.lit("2026-01-25").cast("date"), ranked=False
    )
    stored = portfolio.roll_up_by_stock(out)
    assert rows(stored, "ticker", "portfolio_weight", "fund_count") == [("A", 0.5, 2), ("B", 0.5, 1)]


def test_missing_benchmark_fails_or_counts_as_zero(bars):
    gains = returns.period_returns(bars({"X": [1, 2, 3, 4, 5]}), [5])
    (row,) = portfolio.flag_trending(gains, "SPY", "zero").collect()
    assert row.is_trending and row.benchmark_return == 0
    with pytest.raises(PySparkException, match="no return for benchmark SPY"):
        portfolio.flag_trending(gains, "SPY", "error").collect()
    with pytest.raises(ValueError):
        portfolio.flag_trending(gains, "SPY", "skip")


def test_trending_funds_job(spark, bars):
    prices = bars({"SPY": [100, 101, 102, 103, 104], "UP": [10, 11, 12, 13, 14], "FLAT": [5, 5, 5, 5, 5]})
    meta = spark.createDataFrame(
        [("SPY", "benchmark", None), ("UP", "sector", "Tech")], "ticker string, etf_type string, sector_name string"
    )
    out = jobs.trending_funds(prices, meta, "SPY", "2026-01-05", periods=(5,))
    got = sorted(out.collect(), key=lambda r: r["rank"])
    assert [(r.etf_ticker, r.is_trending, r["rank"], r.period_days) for r in got] == [
        ("UP", True, 1, 5), ("FLAT", False, 2, 5)
    ]
    assert got[0].benchmark_return == pytest.approx(4) and got[1].sector_name is None


def test_upsert_is_idempotent(spark):
    existing = spark.createDataFrame([("A", 1, 1)], "k string, d int, v int")
    incoming = spark.createDataFrame([("A", 1, 2), ("B", 1, 3)], "k string, d int, v int")
    once = sets.upsert_by_key(existing, incoming, ["k", "d"])
    assert rows(once, "k", "v") == [("A", 2), ("B", 3)]
    assert rows(sets.upsert_by_key(once, incoming, ["k", "d"]), "k", "v") == [("A", 2), ("B", 3)]


def test_insert_ignore_and_promote(spark):
    have = spark.createDataFrame([("A", 1)], "k string, v int")
    more = spark.createDataFrame([("A", 9), ("B", 5), ("B", 4)], "k string, v int")
    assert rows(sets.insert_ignore(have, more, ["k"], [F.col("v")]), "k", "v") == [("A", 1), ("B", 4)]
    seen = spark.createDataFrame(
        [("QQQ", "benchmark", None), ("QQQ", "sector", "Technology"), ("SPY", "benchmark", None), ("XLV", "sector", "Healthcare")],
        "ticker string, etf_type string, sector_name string",
    )
    assert rows(sets.upsert_promote_meta(seen), "ticker", "etf_type") == [
        ("QQQ", "both"), ("SPY", "benchmark"), ("XLV", "sector")
    ]


def test_placeholder_filter(spark):
    listed = spark.createDataFrame(
        [("STOCK12", "Real"), ("stock7", "Real"), ("AAPL", "Apple"), ("MSFT", "Stock 12"), ("X", None)],
        "ticker string, name string",
    )
    assert rows(filters.valid_instruments(listed, "ticker", "name"), "ticker") == [("AAPL",)]
    assert rows(filters.valid_instruments(listed), "ticker") == [("AAPL",), ("MSFT",), ("X",)]


def test_ticker_text_helpers(spark):
    df = spark.createDataFrame(
        [(" brk.b ", "Berkshire HATHAWAY BRK inc", None), ("12AB", "no upper", ""), (None, None, "GOOG")],
        "raw string, name string, ticker string",
    )
    got = df.select(
        C.normalized_ticker(F.col("raw")).alias("n"), C.ticker_from_name(F.col("name")).alias("t"),
        C.ticker_or_name_head(F.col("ticker"), F.col("name")).alias("h"),
    ).collect()
    assert [tuple(r) for r in got] == [("BRK.B", "BRK", "Berkshire "), (None, None, "no upper"), (None, None, "GOOG")]


def test_calendar_flags(spark):
    days = spark.createDataFrame([(date(2026, 1, d),) for d in (18, 24, 25, 26, 31)], "d date")
    day = F.col("d")
    got = days.select(C.is_last_sunday(day), C.is_last_weekend(day), C.is_weekday(day)).collect()
    assert [tuple(r) for r in got] == [
        (False, False, False), (False, False, False), (True, True, False), (False, False, True), (False, True, False)
    ]


def test_sector_lookup(spark):
    df = spark.createDataFrame([("XLK",), ("SPY",)], "ticker string")
    assert rows(filters.with_sector(df).na.fill("none"), "ticker", "sector") == [("SPY", "none"), ("XLK", "Technology")]
    assert settings.TREND_UNIVERSE[0] == "SPY" and len(settings.TREND_UNIVERSE) == 12


def test_equal_weight_curve_counts_gaps_as_zero(spark, bars):
    # A trades daily; B starts on day 2 and misses day 3.
    series = bars({"A": [10, 11, 11, 22], "B": [None, 10, None, 5], "IGNORED": [1, 2, 3, 4]})
    names = spark.createDataFrame([("A",), ("B",)], "ticker string")
    got = [r[1] for r in sorted(windows.equal_weight_curve(series, names).collect())]
    day2 = 0.1
    day3 = (0.0 + 0.0) / 2
    day4 = (1.0 - 0.5) / 2
    want, level = [0.0], 1.0
    for change in (day2, day3, day4):
        level *= 1 + change
        want.append((level - 1) * 100)
    assert got == pytest.approx(want)


def test_equal_weight_curve_stays_wiped_out(spark, bars):
    names = spark.createDataFrame([("A",)], "ticker string")
    got = [r[1] for r in sorted(windows.equal_weight_curve(bars({"A": [10, 0, 5]}), names).collect())]
    assert got == pytest.approx([0, -100, -100])


def test_weighted_curve(spark, bars):
    series = bars({"A": [10, 20, 20], "B": [10, None, 30], "LATE": [None, 5, 10]})
    benchmark = bars({"SPY": [100, 110, 120]})
    weights = spark.createDataFrame([("A", 1.0), ("B", 1.0), ("LATE", 2.0), ("NONE", 4.0)], "ticker string, weight double")
    got = [tuple(r)[1:] for r in sorted(windows.weighted_portfolio_curve(series, weights, benchmark).collect())]
    # Weights over the three names with bars: 0.25, 0.25, 0.5; LATE has no base and adds nothing.
    assert got[0] == pytest.approx((0, 0))
    assert got[1] == pytest.approx((25, 10))
    assert got[2] == pytest.approx((25 + 50, 20))
    zero = weights.withColumn("weight", F.lit(0.0))
    plain = [r.portfolio_return for r in sorted(windows.weighted_portfolio_curve(series, zero, benchmark).collect())]
    assert plain == pytest.approx([0, 100, 150])


def test_month_to_date_falls_back_to_history(spark):
    stocks = spark.createDataFrame(
        [("A", "A Inc", "Tech", date(2026, 1, 5), 2.0), ("B", "B Inc", "Tech", date(2026, 1, 6), 3.0),
         ("SPY", "SPY", "Benchmark", date(2026, 2, 2), 9.0)],
        "ticker string, company_name string, sector string, trade_date date, price_change_percent double",
    )
    assert rows(boards.mtd_top_equal_weight(stocks, "2026-02-02", 1), "ticker") == [("B",)]
    assert rows(boards.mtd_top_equal_weight(stocks, "2026-01-06", 5), "ticker") == [("A",), ("B",)]


def test_sector_leaders_without_any_rising_sector(spark):
    stocks = spark.createDataFrame(
        [("A", "A", "S1", date(2026, 1, 5), -2.0), ("B", "B", "S1", date(2026, 1, 5), -1.0),
         ("C", "C", "S2", date(2026, 1, 5), -9.0)],
        "ticker string, company_name string, sector string, trade_date date, price_change_percent double",
    )
    assert rows(boards.sector_leaders(stocks, "2026-01-05", 1), "ticker") == [("B",)]
    assert rows(boards.sector_leaders(stocks, "2026-01-05", 5), "ticker") == [("B",), ("C",)]


def test_period_over_period_needs_two_bars(bars):
    series = bars({"A": [1] * 20 + [10] * 19 + [20], "B": [None] * 39 + [7]}, first=date(2026, 1, 1))
    got = {r.ticker: (r.prev_return, r.current_return, r.change) for r in
           returns.period_over_period(series, "2026-02-09", 20).collect()}
    assert got == {"A": (0.0, 100.0, 100.0), "B": (0.0, 0.0, 0.0)}


def test_benchmark_priority(spark):
    picks = spark.createDataFrame([("XLK", "AAPL"), ("XLF", "JPM")], "etf_ticker string, holding_ticker string")
    held = spark.createDataFrame(
        [("SPY", "AAPL"), ("QQQ", "AAPL"), ("OTHER", "AAPL")], "etf_ticker string, holding_ticker string"
    )
    got = joins.pick_source_fund(picks, held)
    assert rows(got, "holding_ticker", "source_etf", "source_type") == [
        ("AAPL", "QQQ", "benchmark"), ("JPM", "XLF", "trending")
    ]


def test_two_sources(spark):
    schema = "ticker string, seen date, sector string, company_name string"
    d1, d2 = date(2026, 1, 1), date(2026, 1, 2)
    first = spark.createDataFrame([("A", d1, "Old", "A1"), ("A", d2, "New", None), ("B", d1, None, "B1")], schema)
    second = spark.createDataFrame([("A", d1, "Else", "A2"), ("B", d1, "Fill", "B2")], schema)
    assert rows(joins.coalesce_two_sources(first, second), "ticker", "sector", "company_name") == [
        ("A", "New", "A"), ("B", "Fill", "B2")
    ]


def test_bounds_and_gates(spark):
    frame = spark.createDataFrame([(150.0, 10, 1.0), (-100.0, 0, 0.0), (500.0, 5, 2e6)],
                                  "price_change_percent double, volume bigint, close_price double")
    stamps = spark.createDataFrame([("2026-01-25T10:30:00Z",), ("2026-01-25T10:30:00",), ("noon",), (None,)],
                                   "raw_timestamp string")
    got = {r.rule: (r.observed, r.passed) for r in quality.bounds_checks(frame, stamps).collect()}
    assert got == {
        "return_within_bounds": (2.0, False), "volume_positive": (1.0, False),
        "price_within_bounds": (2.0, False), "timestamp_readable": (1.0, False),
    }
    good = spark.createDataFrame([("P", 0.6), ("P", 0.399)], "p string, w double")
    (row,) = quality.verify_weights(good, ["p"], "w", max_rows=1).collect()
    assert row.weight_ok and not row.size_ok
    (rate,) = quality.collection_success(
        spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "ticker string"),
        spark.createDataFrame([("A",), ("A",)], "ticker string"),
    ).collect()
    assert (rate.success_rate, rate.too_many_failures, rate.below_success_floor) == (25.0, True, True)


def test_table_edge_types(spark):
    df = spark.createDataFrame([("SPY", date(2026, 1, 5), 1.005, 3)], "ticker string, trade_date date, close_price double, extra int")
    out = schemas.to_table(df, schemas.FUND_PRICES)
    assert out.schema == schemas.FUND_PRICES
    assert str(out.first().close_price) in ("1.01", "1.00")


def test_hourly_figures(spark):
    at = lambda m: datetime(2026, 1, 25, 10, m)
    ticks = spark.createDataFrame(
        [("AAPL", "Tech", at(15), 185.40, 100000), ("AAPL", "Tech", at(30), 185.42, 200000),
         ("AAPL", "Tech", at(45), 185.50, 150000), ("MSFT", "Tech", at(20), 380.5, 50000)],
        "ticker string, sector string, ts timestamp, price double, volume bigint",
    )
    from fundtide.streaming.ingest import hourly

    got = {r.ticker: r for r in hourly(ticks).collect()}["AAPL"]
    assert got.avg_price == pytest.approx(185.44)
    assert (got.min_price, got.max_price, got.total_volume, got.record_count) == (185.40, 185.50, 450000, 3)


def test_worklist_uses_names_for_missing_tickers(spark):
    trending = spark.createDataFrame([("F", True), ("G", False)], "etf_ticker string, is_trending boolean")
    holdings = spark.createDataFrame(
        [("F", "A", "A Inc", 9.0, date(2026, 1, 2)), ("F", "", "Some IBM corp", 8.0, date(2026, 1, 2)),
         ("F", "OLD", "Old", 99.0, date(2026, 1, 1)), ("F", "B", "B", 7.0, date(2026, 1, 2)),
         ("G", "Z", "Z", 9.0, date(2026, 1, 2))],
        "etf_ticker string, holding_ticker string, holding_name string, holding_percent double, as_of_date date",
    )
    stocks = spark.createDataFrame([("A", date(2026, 1, 5)), ("B", date(2026, 1, 4))], "ticker string, trade_date date")
    assert rows(jobs.collection_worklist(trending, holdings, stocks, "2026-01-05"), "ticker") == [("B",), ("IBM",)]
