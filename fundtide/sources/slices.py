"""Tables that a stream writes batch by batch, kept in few files.

A batch writes its own slice, so a replay replaces what it wrote.  Slices pile up: one folder
per day and batch.  Compaction merges the closed ones day by day and says so in a table of
marks, which is its commit; readers take the newest merged version of each day and the slices
that no mark covers.

    raw/<day>/batch_id=n      slices
    merged/<day>/upto=u       what the batches up to u hold of that day
    marks/upto=u              the days that compaction u merged; written last

A compaction that stops half-way leaves no mark and is done again over the same folders.  What
a mark has replaced is deleted by the next compaction, so readers that started before still
find their files.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundtide.sources import sinks

BATCH, UPTO = "batch_id", "upto"
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class Slices:
    """``columns`` is the schema of the rows, with the partition column ``day``.

    ``merge`` makes one row set of the rows of a day from several batches (sums that are added
    up, for instance); None keeps all rows.
    """

    def __init__(
        self, spark: SparkSession, path: str, columns: T.StructType, day: str,
        merge: Callable[[DataFrame], DataFrame] | None = None,
    ):
        self._spark, self.path, self._day = spark, path, day
        self._merge = merge or (lambda rows: rows)
        self._names = columns.fieldNames()
        plain = [f for f in columns.fields if f.name != day]
        mark = T.StructField(day, columns[day].dataType)
        self._schemas = {
            "raw": T.StructType([*plain, mark, T.StructField(BATCH, T.LongType())]),
            "merged": T.StructType([*plain, mark, T.StructField(UPTO, T.LongType())]),
            "marks": T.StructType([mark, T.StructField(UPTO, T.LongType())]),
        }

    def _read(self, part: str) -> DataFrame:
        found = sinks.read_or_none(self._spark, f"{self.path}/{part}", self._schemas[part])
        return self._spark.createDataFrame([], self._schemas[part]) if found is None else found

    def covered(self) -> int:
        """The last batch that is merged; -1 without any.  Only folder names are read."""
        newest = self._read("marks").agg(F.max(UPTO)).first()[0]
        return -1 if newest is None else newest

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Write the slice of a batch, a few files however many tasks the rows come from.

        A batch that is already merged has been written before: nothing to do.
        """
        if batch_id > self.covered():
            rows = rows.select(*self._names).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
            sinks.replace_slices(rows.hint("rebalance", self._day), f"{self.path}/raw", [self._day, BATCH])

    def rows(self, before: int | None = None, days: Sequence | None = None) -> DataFrame:
        """All rows; of the batches ``before`` one, or of some days, whose folders alone are opened.

        ``before`` must be a batch that is not merged.
        """
        covered = self.covered()
        raw = self._read("raw").filter(F.col(BATCH) > covered)
        if before is not None:
            raw = raw.filter(F.col(BATCH) < before)
        merged = self._newest_versions(covered)
        if days is not None:
            raw, merged = (sinks.only_partitions(part, self._day, days) for part in (raw, merged))
        return merged.select(*self._names).unionByName(raw.select(*self._names))

    def _newest_versions(self, covered: int) -> DataFrame:
        """Rows of the newest merged version of each day, up to compaction ``covered``."""
        marks = self._read("marks").filter(F.col(UPTO) <= covered).groupBy(F.col(self._day).alias("_day")).agg(
            F.max(UPTO).alias("_upto"))
        merged = self._read("merged")
        return merged.join(marks, merged[self._day].eqNullSafe(marks["_day"]) & (merged[UPTO] == marks["_upto"])).drop("_day", "_upto")

    def compact(self, before: int) -> None:
        """Merge the slices of all batches before ``before``, which must be closed: never replayed."""
        covered, last = self.covered(), before - 1
        self._clean(covered)
        fresh = self._read("raw").filter((F.col(BATCH) > covered) & (F.col(BATCH) <= last))
        days = [r[0] for r in fresh.select(self._day).distinct().limit(sinks.MOST_PARTITIONS + 1).collect()]
        if len(days) > sinks.MOST_PARTITIONS:
            raise ValueError(f"a compaction covers more than {sinks.MOST_PARTITIONS} days")
        if not days:
            return
        old = sinks.only_partitions(self._newest_versions(covered), self._day, days)
        rows = self._merge(old.select(*self._names).unionByName(fresh.select(*self._names))).select(*self._names)
        # Tasks by day, large days split and small ones put together at run time.
        rows = rows.withColumn(UPTO, F.lit(last).cast("bigint")).hint("rebalance", self._day)
        sinks.replace_slices(rows, f"{self.path}/merged", [self._day, UPTO])
        marks = self._spark.createDataFrame([(d, last) for d in days], self._schemas["marks"])
        sinks.replace_slices(marks.coalesce(1), f"{self.path}/marks", [UPTO])

    def _clean(self, covered: int) -> None:
        """Delete slices and versions that the marks up to ``covered`` have replaced."""
        if covered < 0:
            return
        newest = {r[0]: r[1] for r in self._read("marks").groupBy(self._day).agg(F.max(UPTO)).collect()}
        old = [("raw", r[0], BATCH, r[1]) for r in self._folders("raw", BATCH) if r[1] <= covered]
        old += [("merged", r[0], UPTO, r[1]) for r in self._folders("merged", UPTO) if r[1] != newest.get(r[0])]
        for part, day, name, number in old:
            folder = _NULL_FOLDER if day is None else str(day)
            self._delete(f"{self.path}/{part}/{self._day}={folder}/{name}={number}")

    def _folders(self, part: str, name: str) -> list:
        return self._read(part).select(self._day, name).distinct().collect()

    def _delete(self, path: str) -> None:
        folder = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(folder, True)
