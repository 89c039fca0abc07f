"""Stored daily bars whose change against the bar before is kept up to date.

The change of a bar needs the close of its predecessor, which may lie months back, so
computing it on reading costs the whole history.  Here it is a column of the table, and a
write maintains it: bars that arrive, late or corrected ones included, change their own
month and at most the first bar of the ticker's next month with bars.  A reader of the last
days opens the folders of their months only.

Two folders, both partitioned by ``trade_month``: ``bars``, and ``edges`` with one row per
ticker and month (its last close), which is what a month needs to know of the months before.
One writer at a time; a write that is run again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundtide.functions.columns import pct_change
from fundtide.operators.sets import upsert_by_key
from fundtide.operators.windows import daily_change
from fundtide.sources import sinks, workspace

MONTH, CHANGE = "trade_month", "price_change_percent"


class StoredBars:
    """A table of bars, unique by (ticker, trade_date), in the folder ``path``.

    ``columns`` is the schema of the bars; it has ticker, trade_date and close_price, and not
    the month or the change.
    """

    def __init__(self, spark: SparkSession, path: str, columns: T.StructType):
        self._spark, self.path = spark, path
        self._given = columns.fieldNames()
        self._schema = T.StructType([
            *columns.fields, T.StructField(CHANGE, T.DoubleType()), T.StructField(MONTH, T.DateType())])
        kinds = {f.name: f.dataType for f in columns.fields}
        self._edge_schema = T.StructType([
            T.StructField("ticker", kinds["ticker"]), T.StructField("last_close", kinds["close_price"]),
            T.StructField(MONTH, T.DateType())])

    def bars(self) -> DataFrame:
        """All bars with change and month; filter by month (as ``since`` does) to open few folders."""
        return self._spark.read.schema(self._schema).parquet(f"{self.path}/bars")

    def edges(self) -> DataFrame:
        return self._spark.read.schema(self._edge_schema).parquet(f"{self.path}/edges")

    def create(self, bars: DataFrame) -> None:
        """Fill the empty table: the only time that the whole history is put in order.

        Files are sorted by day, so their row groups can be skipped within a month too.
        """
        rows = daily_change(bars.select(*self._given)).withColumn(MONTH, F.trunc("trade_date", "month"))
        _put(rows, f"{self.path}/bars")
        _put(_edges(self.bars()), f"{self.path}/edges")

    def upsert(self, incoming: DataFrame, order: Sequence[Column] = ()) -> None:
        """Insert or replace bars by (ticker, trade_date); of several for a key the first in ``order`` wins.

        Reads and rewrites the months of ``incoming`` and those with the next bar of one of its
        tickers.  Other tickers' changes in these months are taken over as they are.
        """
        with workspace.scratch(self._spark):
            fresh = workspace.materialized(
                incoming.select(*self._given).withColumn(MONTH, F.trunc("trade_date", "month")), "incoming")
            touched = _months(fresh)
            if not touched:
                return
            old = sinks.read_or_none(self._spark, f"{self.path}/bars", self._schema)
            if old is None:
                old = self._spark.createDataFrame([], self._schema)
            merged = workspace.materialized(upsert_by_key(
                sinks.only_partitions(old, MONTH, touched), fresh, ["ticker", "trade_date"], order), "merged")
            edges = workspace.materialized(_edges(merged), "edges")

            timeline = self._timeline(fresh, edges, touched)
            # Where the bar before a month has changed though nothing in the month has.
            later = _months(timeline.filter(~F.col("touched") & F.col("after_change")))
            pool = merged.unionByName(sinks.only_partitions(old, MONTH, later)) if later else merged
            pool = _with_change(pool, timeline.filter(F.col("touched") | F.col("after_change")))
            rewritten = workspace.materialized(pool.select(*self._schema.fieldNames()), "rewritten")
            _put(rewritten, f"{self.path}/bars")
            _put(edges, f"{self.path}/edges")

    def _timeline(self, fresh: DataFrame, edges: DataFrame, touched: Sequence[date]) -> DataFrame:
        """Months of the incoming tickers from the first touched one on, each with the close carried into it.

        ``after_change`` tells that this close is another one than before.  A ticker has at most
        one row per month of the calendar.
        """
        names = fresh.select("ticker").distinct()
        first = min(touched)
        known = sinks.read_or_none(self._spark, f"{self.path}/edges", self._edge_schema)
        own = edges.join(names, "ticker", "left_semi")
        parts = []
        if known is None:
            own = own.withColumn("changed", F.lit(True))
        else:
            known = known.join(names, "ticker", "left_semi")
            was = known.filter(F.col(MONTH).isin(*touched)).withColumnRenamed("last_close", "was").withColumn("old", F.lit(True))
            own = own.join(was, ["ticker", MONTH], "left").withColumn(
                "changed", F.col("old").isNull() | ~F.col("was").eqNullSafe(F.col("last_close"))).drop("was", "old")
            before = known.filter(F.col(MONTH) < F.lit(first)).groupBy("ticker").agg(
                F.max_by("last_close", MONTH).alias("last_close"), F.max(MONTH).alias(MONTH))
            after = known.filter((F.col(MONTH) > F.lit(first)) & ~F.col(MONTH).isin(*touched))
            parts = [p.withColumns({"changed": F.lit(False), "touched": F.lit(False)}) for p in (before, after)]
        rows = own.withColumn("touched", F.lit(True))
        for part in parts:
            rows = rows.unionByName(part)
        by_month = Window.partitionBy("ticker").orderBy(MONTH)
        return workspace.materialized(rows.select(
            "ticker", MONTH, "touched", F.lag("last_close").over(by_month).alias("carried"),
            F.coalesce(F.lag("changed").over(by_month), F.lit(False)).alias("after_change")), "timeline")


def _put(rows: DataFrame, path: str) -> None:
    """Replace the months of ``rows``, a few files each: large months are split at run time, small ones share a task."""
    rows = rows.hint("rebalance", MONTH)
    sinks.replace_slices(rows.sortWithinPartitions(MONTH, *[c for c in ("trade_date",) if c in rows.columns]), path, [MONTH])


def _months(rows: DataFrame) -> list[date]:
    found = [r[0] for r in rows.select(MONTH).distinct().limit(sinks.MOST_PARTITIONS + 1).collect()]
    if len(found) > sinks.MOST_PARTITIONS:
        raise ValueError(f"a write touches more than {sinks.MOST_PARTITIONS} months")
    if None in found:
        raise ValueError("a bar has no trade_date")
    return found


def _edges(bars: DataFrame) -> DataFrame:
    return bars.groupBy("ticker", MONTH).agg(F.max_by("close_price", "trade_date").alias("last_close")).select(
        "ticker", "last_close", MONTH)


def _with_change(pool: DataFrame, carried: DataFrame) -> DataFrame:
    """New changes for the (ticker, month) pairs of ``carried``; the others keep theirs."""
    own = Window.partitionBy("ticker", MONTH).orderBy("trade_date")
    rows = pool.withColumn("_previous", F.lag("close_price").over(own)).withColumn("_first", F.row_number().over(own) == 1)
    rows = rows.join(carried.select("ticker", MONTH, "carried", F.lit(True).alias("_anew")), ["ticker", MONTH], "left")
    previous = F.when(F.col("_first"), F.col("carried")).otherwise(F.col("_previous"))
    change = F.coalesce(pct_change(F.col("close_price"), previous), F.lit(0.0))
    return rows.withColumn(CHANGE, F.when(F.col("_anew"), change).otherwise(F.col(CHANGE)))
