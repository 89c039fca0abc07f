"""Shapes of physical plans that must hold at any size."""

import pytest
from pyspark.sql import functions as F

from fundtide import catalog
from fundtide.functions.dates import Clock
from fundtide.operators.windows import since
from fundtide.sources.market import event_market, line_market

SF = "/root/testdata/sf0.001"

# Queries that run streams or write tables return a plan over what they wrote.
LAZY = sorted(
    k for k in catalog.queries()
    if not k.startswith(("stream_", "hourly_tumbling")) and not k.endswith("_sink") and "dead_letter" not in k
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", LAZY)
def test_no_python_no_cross_join_no_unpartitioned_window(spark, key):
    text = plan(catalog.queries()[key](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert bad not in text
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line and key != "equal_weight_curve":
            # A window over one single partition would gather the table in a task.
            # (The curve compounds one row per trading day, aggregated before.)
            below = "\n".join(lines[i:i + 6])
            assert "Exchange SinglePartition" not in below


def test_columns_are_pruned(spark):
    m = line_market(spark, SF)
    text = plan(m.fund_prices.select("ticker", "trade_date", "volume"))
    assert "Window" not in text  # the daily change nobody asked for
    assert "l_extendedprice" not in text and "l_partkey" not in text


def test_filters_reach_the_scan(spark):
    m = event_market(spark, SF, last_days=5)
    scan = next(x for x in plan(m.stock_prices.select("ticker")).splitlines() if "FileScan" in x and "user_id" in x)
    assert "ts" in scan.split("DataFilters")[1]
    stocks = line_market(spark, SF).stock_prices.filter(F.col("sector") == "PROMO")
    scans = [x for x in plan(stocks).splitlines() if "FileScan" in x and "p_type" in x]
    assert scans and "EqualTo(p_type,PROMO)" in scans[0]


def test_dimension_is_broadcast_by_its_size_only(spark):
    m = line_market(spark, SF)
    joined = m.stock_prices.select("ticker", "sector", "close_price")
    assert "BroadcastHashJoin" in plan(joined)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(line_market(spark, SF).stock_prices.select("ticker", "sector"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _scan_rows(df):
    """Rows the scans of an executed plan put out."""
    df.collect()

    def scans(node):
        if node.nodeName().startswith("Scan"):
            yield node.metrics().apply("numOutputRows").value()
        if node.nodeName() == "AdaptiveSparkPlan":
            yield from scans(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            yield from scans(node.plan())
        for i in range(node.children().size()):
            yield from scans(node.children().apply(i))

    return sum(scans(df._jdf.queryExecution().executedPlan()))


def test_clock_bounds_prune_files_and_row_groups(spark, folder):
    path = folder("bars")
    bars = event_market(spark, SF).stock_prices.select("ticker", "trade_date", "close_price")
    bars.repartitionByRange(10, "trade_date").sortWithinPartitions("trade_date").write.parquet(path)
    stored = spark.read.parquet(path)
    recent = since(stored, Clock(stored, F.col("trade_date")), 3)
    assert 0 < _scan_rows(recent) < stored.count() / 2
    assert recent.count() == since(stored, "2024-01-30", 3).count() > 0


def test_clock_bounds_prune_months(spark, folder):
    path = folder("orders")
    spark.read.parquet(f"{SF}/orders.parquet").select(
        F.col("o_orderkey").alias("key"), F.to_date("o_orderdate").alias("trade_date")
    ).withColumn("trade_month", F.trunc("trade_date", "month")).repartition(2).write.partitionBy("trade_month").parquet(path)
    stored = spark.read.parquet(path)
    recent = since(stored, Clock(stored, F.col("trade_date")), 40)
    assert 0 < _scan_rows(recent) < stored.count() / 10
