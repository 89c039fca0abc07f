"""Analysis dates.

Operators take ``as_of`` as a date, an ISO text, a column, or a :class:`Clock`.
All but a column become literals, so the bounds derived from them prune
partitions and row groups.  (Bounds computed by scalar subqueries do not: Spark
merges the subqueries of a plan into one struct, which no scan accepts.)
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Clock:
    """The newest day of a table: one value from one column, looked up on first use.

    Of a table partitioned by ``trade_month`` only the newest month is opened.
    """

    def __init__(self, rows: DataFrame, day: Column):
        self._rows = rows
        self._day = day

    @cached_property
    def newest(self) -> date | None:
        rows = self._rows
        if "trade_month" in rows.columns:
            rows = rows.filter(F.col("trade_month") == F.lit(rows.agg(F.max("trade_month")).first()[0]))
        return rows.agg(F.to_date(F.max(self._day)).alias("newest")).first()["newest"]


def _literal(as_of, back: int) -> date | None:
    value = as_of.newest if isinstance(as_of, Clock) else as_of
    if isinstance(value, str):
        value = date.fromisoformat(value)
    return None if value is None else value - timedelta(days=back)


def day(as_of, back: int = 0) -> Column:
    """``as_of`` minus ``back`` days."""
    if isinstance(as_of, Column):
        return F.date_sub(as_of, back) if back else as_of
    return F.lit(_literal(as_of, back)).cast("date")


def month(as_of, back: int = 0) -> Column:
    """First day of the month of ``as_of`` minus ``back`` days."""
    if isinstance(as_of, Column):
        return F.trunc(day(as_of, back), "month")
    value = _literal(as_of, back)
    return F.lit(value and value.replace(day=1)).cast("date")
