"""Labelled documents, all or a bounded sample, from which classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundtide.llm import textops

_MARKS = 1 << 40


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the doc_id as text, modulo ``parts``; null for a null doc_id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(parts))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, allowed: Column | None = None) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` documents per label value.

    The documents are the first in the order of a hash of doc_id, so the sample is spread
    evenly and does not depend on the layout.  Of a doc_id labelled twice, the larger label
    counts; of a doc_id that stands for several texts, one text.  ``allowed`` is a condition
    on doc_id.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(f"`{label}`").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    if allowed is not None:
        known = known.filter(allowed)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    # A hash bound per label leaves about twice the rows wanted, whatever the label's size.
    bound = F.lit(None).cast("bigint")
    for row in known.groupBy("label").count().collect():
        share = min(1.0, (2 * per_class + 100) / row["count"])
        bound = F.when(F.col("label") == row["label"], int(share * _MARKS)).otherwise(bound)
    known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(_MARKS)) <= bound)
    order = Window.partitionBy("label").orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(_MARKS)), "doc_id")
    chosen = known.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_class).drop("_n")
    # At most per_class rows per label value: small by construction.
    rows = textops.documents(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id").agg(F.max_by("text", F.xxhash64("text")).alias("text"), F.first("label").alias("label"))


def every(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, text, label) of every labelled document, by the rules of :func:`sample` but uncapped."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(f"`{label}`").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = textops.documents(docs, "doc_id", "text").join(known, "doc_id")
    return rows.groupBy("doc_id").agg(F.max_by("text", F.xxhash64("text")).alias("text"), F.first("label").alias("label"))
