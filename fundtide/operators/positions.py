"""Positions and fund totals from one pass over the trades.

A percent of a position needs the total of its fund's snapshot, which can be a large part of
the table: too large for a window, and a second grouping would read the trades again.  Here
both are grouping sets of one aggregate, written once, in a folder each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundtide.sources.workspace import materialized


@dataclass(frozen=True)
class Book:
    """``positions`` has one row per fund, stock and snapshot; ``totals`` one per fund and snapshot."""

    positions: DataFrame
    totals: DataFrame
    fund: str
    stock: str
    snapshot: str

    @classmethod
    def of(
        cls, trades: DataFrame, fund: str, stock: str, snapshot: str, value: str, measures: Sequence[Column]
    ) -> Book:
        """Group ``trades``; ``value`` is summed up for both, ``measures`` are further aggregates of a position.

        Partial aggregation leaves one row per group and task, so a hot fund or stock costs no
        more.  A NULL stock is a stock: only the grouping bit tells totals apart.
        """
        keys = [fund, stock, snapshot]
        grouped = trades.groupingSets([keys, [fund, snapshot]], *keys).agg(
            F.sum(value).alias(value), *measures, F.grouping(stock).cast("int").alias("is_total"))
        book = materialized(grouped, "book", ["is_total"])
        totals = book.filter("is_total = 1").select(fund, snapshot, F.col(value).alias("total"))
        return cls(book.filter("is_total = 0").drop("is_total"), totals, fund, stock, snapshot)

    def newest(self) -> DataFrame:
        """The total of every fund's newest snapshot, from the few rows of totals."""
        return self.totals.groupBy(self.fund).agg(
            F.max(self.snapshot).alias(self.snapshot), F.max_by("total", self.snapshot).alias("total"))

    def with_share(self, value: str, newest: bool = False) -> DataFrame:
        """Positions with ``total`` and their value's percent of it; ``newest``: of the newest snapshots only.

        The totals pick the snapshot and bring the denominator in the same join.
        """
        totals = self.newest() if newest else self.totals
        share = F.try_divide(F.col(value), F.col("total")) * F.lit(100.0)
        return self.positions.join(totals, [self.fund, self.snapshot]).withColumn("holding_percent", share)
