"""Distributed ranks and the monthly cut against brute force, with hot groups."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from fundtide.operators import portfolio, ranking, sets, windows
from fundtide.operators.returns import period_returns


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_global_rank_equals_sorting(spark, seed):
    rng = random.Random(seed)
    # One group holds most rows, many scores are equal.
    rows = [
        ("hot" if rng.random() < 0.7 else f"g{rng.randrange(4)}", float(rng.randrange(30)), f"k{i:05d}")
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "g string, score double, key string").repartition(7)
    got = {r.key: r["rank"] for r in ranking.global_rank(df, ["g"], [F.col("score").desc(), F.col("key")]).collect()}
    want = {}
    for group in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == group), key=lambda r: (-r[1], r[2]))
        want.update({r[2]: i for i, r in enumerate(ordered, 1)})
    assert got == want


def test_global_rank_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, score double, key string")
    assert ranking.global_rank(empty, ["g"], [F.col("score").desc()]).collect() == []


def _final_by_sorting(scored, size=20, first_new=20):
    best_first = sorted(scored, key=lambda r: (-r[2], -r[3], r[0]))
    overall = {r[0]: i for i, r in enumerate(best_first, 1)}
    new_place = {r[0]: i for i, r in enumerate((r for r in best_first if r[1]), 1)}
    number = {r[0]: new_place[r[0]] + first_new - 1 if r[1] else overall[r[0]] for r in scored}
    kept = sorted(scored, key=lambda r: (number[r[0]], r[1], r[0]))[:size]
    total = sum(r[2] for r in kept)
    return [(r[0], i, round(r[2] / total, 9)) for i, r in enumerate(kept, 1)]


@pytest.mark.parametrize("existing,new", [(0, 50), (5, 5), (30, 100), (3, 60), (60, 3), (1, 45), (12, 25), (25, 0)])
def test_final_ranks_equal_the_full_sort(spark, existing, new):
    rng = random.Random(existing * 1000 + new)
    scored = [(f"E{i}", False, float(rng.choice([1, 2, 3])), float(rng.randrange(50))) for i in range(existing)]
    scored += [(f"N{i}", True, float(rng.choice([0.3, 0.5, 2.0])), float(rng.randrange(50))) for i in range(new)]
    df = spark.createDataFrame(scored, "ticker string, is_new boolean, score double, return_20 double").withColumn(
        "as_of_date", F.lit(date(2026, 1, 25))
    )
    out = portfolio.assign_final_ranks(df).collect()
    got = sorted(((r.ticker, r.final_rank, round(r.final_weight, 9)) for r in out), key=lambda r: r[1])
    assert got == _final_by_sorting(scored)


def test_new_names_never_push_past_the_cut(spark):
    """All new names outrank the existing one: its overall rank lies beyond every new number."""
    scored = [("E", False, 1.0, 1.0)] + [(f"N{i:03d}", True, 2.0, float(i)) for i in range(500)]
    df = spark.createDataFrame(scored, "ticker string, is_new boolean, score double, return_20 double").withColumn(
        "as_of_date", F.lit(date(2026, 1, 25))
    )
    out = portfolio.assign_final_ranks(df).collect()
    got = sorted(((r.ticker, r.final_rank, round(r.final_weight, 9)) for r in out), key=lambda r: r[1])
    assert got == _final_by_sorting(scored)


def test_hot_key_upsert_keeps_the_last_version(spark):
    versions = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("k"),
        F.col("id").alias("seq"),
    )
    out = sets.upsert_by_key(versions.limit(0), versions, ["k"], [F.col("seq").desc()])
    got = {r.k: r.seq for r in out.collect()}
    assert len(got) == 501 and got["hot"] == 19998


def test_row_limits_reach_the_map_side(spark, bars):
    plan = windows.last_n_rows(bars({"A": range(1, 30)}), 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    carried = period_returns(
        bars({"A": range(1, 30)}).withColumn("name", F.lit("x")), carry=["name"]
    )._jdf.queryExecution().executedPlan().toString()
    assert carried.count("WindowGroupLimit") == 2


def test_a_null_group_is_ranked_like_any_other(spark):
    from pyspark.sql import functions as F

    from fundtide.operators import ranking

    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2)], "g string, v int")
    got = sorted((r.g or "", r.v, r["rank"]) for r in ranking.global_rank(df, ["g"], [F.col("v")]).collect())
    assert got == [("", 1, 1), ("", 3, 2), ("a", 2, 1)]


def test_holdings_without_percents_keep_their_order_of_arrival(spark):
    from fundtide.operators import ranking

    df = spark.createDataFrame(
        [("A", "x", 1.0, 3), ("A", "y", None, 1), ("A", "z", 2.0, 2), ("A", "w", 1.0, 2),
         ("B", "x", None, 3), ("B", "y", None, 1), ("B", None, None, 0)],
        "etf_ticker string, holding_ticker string, holding_percent double, arrival int")
    got = {}
    for r in ranking.top_by_weight(df, 3, arrival="arrival").orderBy("etf_ticker", "rank").collect():
        got.setdefault(r.etf_ticker, []).append(r.holding_ticker)
    assert got == {"A": ["z", "w", "x"], "B": ["y", "x"]}
