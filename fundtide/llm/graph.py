"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtide.sources.workspace import materialized

#: Rows of a link table per task.  A table of fewer needs no shuffle.
TASK_LINKS = 100_000


def dealt(rows: DataFrame) -> DataFrame:
    """A written table in as many tasks as its rows ask for, not as there are files or shuffle partitions."""
    return rows.coalesce(max(1, -(-rows.count() // TASK_LINKS)))


def _stars(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Connect neighbours to the least one.

    ``both_ways``: every node's larger neighbours; else every node and its smaller ones.
    """
    if both_ways:
        around = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = around.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(least, "u")
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component): the least id that each id of ``links(a, b)`` is connected with.

    Alternates the two star steps until only stars are left: no centre has another centre.  A
    step never holds more rows than there are links, and hubs are aggregated before the shuffle.
    """
    edges = dealt(materialized(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges"))
    while not edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty() or not _one_centre(edges):
        edges = dealt(materialized(_stars(_stars(edges, True), False), "edges"))
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component")))


def _one_centre(edges: DataFrame) -> bool:
    return edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def extended(known: DataFrame | None, links: DataFrame) -> DataFrame:
    """(id, component) when ``links(a, b)`` are added to what ``known`` (id, component) connects.

    Known components are contracted to their least ids first, so the work is that of the new
    links and not of all so far.
    """
    if known is None:
        return dealt(materialized(components(links), "components"))

    def end(side: str) -> DataFrame:
        return known.select(F.col("id").alias(side), F.col("component").alias(f"_{side}"))

    contracted = links.select("a", "b").join(end("a"), "a", "left").join(end("b"), "b", "left").select(
        F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    above = components(contracted)
    moved = known.join(above.select(F.col("id").alias("component"), F.col("component").alias("top")), "component", "left").select(
        "id", F.coalesce("top", "component").alias("component"))
    return dealt(materialized(moved.unionByName(above.join(known, "id", "left_anti")), "components"))
