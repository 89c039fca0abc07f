"""Set operations and keyed merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundtide.operators.windows import top_k_per_group


def union_by_name(first: DataFrame, *more: DataFrame) -> DataFrame:
    out = first
    for frame in more:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def dedup_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropDuplicates(list(keys))


def union_universe(
    benchmarks: DataFrame, sector_funds: DataFrame, only: DataFrame | None = None
) -> DataFrame:
    """Benchmarks and sector funds under one schema with a type label, optionally filtered by a list."""
    labelled = benchmarks.select(
        "ticker", F.lit("benchmark").alias("etf_type"), F.lit(None).cast("string").alias("sector_name")
    ).unionByName(
        sector_funds.select("ticker", F.lit("sector").alias("etf_type"), "sector_name")
    )
    return labelled if only is None else labelled.join(only.select("ticker"), "ticker", "left_semi")


def upsert_by_key(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """Insert or update on a natural key.

    Incoming rows beat existing ones; among incoming rows the first in ``order``
    wins (pass the arrival sequence descending).  Only one row per key and task
    leaves the map side, whatever the number of versions of a key.
    """
    ranked = existing.withColumn("_fresh", F.lit(0)).unionByName(
        incoming.withColumn("_fresh", F.lit(1)), allowMissingColumns=True
    )
    return top_k_per_group(ranked, keys, [F.col("_fresh").desc(), *order], 1, "_version").drop(
        "_fresh", "_version"
    )


def insert_ignore(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Existing rows plus the first incoming row of every key not yet present."""
    fresh = top_k_per_group(incoming, keys, order, 1, "_n").drop("_n")
    new = fresh.join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(new.select(*existing.columns))


def upsert_promote_meta(seen: DataFrame) -> DataFrame:
    """One row per fund; a fund seen both as benchmark and as sector fund becomes ``both``.

    ``seen`` is (ticker, etf_type, sector_name).
    """
    as_benchmark = F.max((F.col("etf_type") == "benchmark").cast("int")) == 1
    as_sector = F.max((F.col("etf_type") == "sector").cast("int")) == 1
    return seen.groupBy("ticker").agg(
        F.when(as_benchmark & as_sector, "both")
        .when(as_sector, "sector")
        .otherwise("benchmark")
        .alias("etf_type"),
        F.max(F.when(F.col("etf_type") == "sector", F.col("sector_name"))).alias("sector_name"),
    )
