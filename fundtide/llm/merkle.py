"""Merkle manifest of a dataset: one digest that any changed row breaks, and short proofs.

Every row is a leaf.  The leaves of a group (here a language) ascend by key and are hashed
in runs of ``fanout`` siblings, level by level, to the group's subroot; the subroots, in
the order of their groups, give the root in the same way.

A level is a table (group, idx, n, digest, left, right).  Its siblings come from lag and
lead windows: one column per fixed offset, masked by the slot of the row in its run and by
the run's length; rows in slot 0 hash the parents.  Windows are partitioned by blocks of
whole runs, so a group of any size spreads over all tasks, and positions come from a range
sort and the row counts of its ranges.

Null keys ascend first, then rows by key and leaf digest, so ties and repeated rows have a
place each (equal rows have equal leaves).  A null group is a group of its own, the first.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundtide.llm import textops
from fundtide.sources.workspace import materialized

FANOUT = 8
#: Runs of siblings in one window partition.
RUNS = 512

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition number above this bit


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def leaf(*fields: Column) -> Column:
    """Hex sha256 of the fields: ``-`` for null, else byte count, ``:`` and the value as text."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def _placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with idx (from 0) and n (rows) in their group; no group is sorted in one task."""
    sorted_rows = materialized(
        rows.orderBy("group", *order).withColumn("_at", F.monotonically_increasing_id()), "leaves"
    ).withColumn("_range", F.shiftright("_at", _POSITION_BITS))
    # One row per range and group.
    earlier = Window.partitionBy("group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sorted_rows.groupBy("group", "_range").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    ranges = ranges.select("group", "_range", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
                           F.sum("_rows").over(Window.partitionBy("group")).alias("n"))
    placed = sorted_rows.join(ranges, ["group", "_range"])
    return placed.withColumn("idx", F.col("_at") + F.col("_shift")).drop("_at", "_shift", "_range")


def _with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` with the digests of the run's earlier and later siblings, each concatenated."""
    window = Window.partitionBy("group", "_block").orderBy("idx")
    slot = F.col("idx") % fanout
    length = F.least(F.lit(fanout), F.col("n") - F.col("idx") + slot)
    nodes = nodes.withColumn("_block", F.floor(F.col("idx") / (fanout * RUNS)))
    none = F.unhex(F.lit(""))
    left = [F.when(slot >= k, F.lag("digest", k).over(window)) for k in range(fanout - 1, 0, -1)]
    right = [F.when(slot + k < length, F.lead("digest", k).over(window)) for k in range(1, fanout)]
    join = lambda found: F.concat(*[F.coalesce(d, none) for d in found])
    return nodes.select("*", join(left).alias("left"), join(right).alias("right")).drop("_block")


@dataclass(frozen=True)
class Tree:
    """``levels[0]`` has the rows it was built from; ``tops`` one (group, digest) per group."""

    levels: list[DataFrame]
    tops: DataFrame
    fanout: int

    @classmethod
    def build(cls, rows: DataFrame, order: list[Column], fanout: int = FANOUT) -> Tree:
        """Trees over ``rows`` (group string, digest binary, other columns kept at the leaves).

        The number of levels is the logarithm of the largest group, the only value that the
        driver looks at.
        """
        placed = _placed(rows, order)
        level = materialized(_with_siblings(placed, fanout), "level")
        most = level.agg(F.max("n")).first()[0] or 0
        levels = [level]
        while most > 1:
            most = -(-most // fanout)
            parents = levels[-1].filter((F.col("n") > 1) & (F.col("idx") % fanout == 0)).select(
                "group", (F.col("idx") / fanout).cast("bigint").alias("idx"),
                F.ceil(F.col("n") / fanout).cast("bigint").alias("n"),
                F.unhex(F.sha2(F.concat(_hex(F.col("digest")), _hex(F.col("right"))), 256)).alias("digest"))
            levels.append(materialized(_with_siblings(parents, fanout), "level"))
        tops = reduce(DataFrame.unionByName, [x.filter("n = 1").select("group", "digest") for x in levels])
        return cls(levels, tops, fanout)

    def nodes(self) -> DataFrame:
        """The manifest itself: (group, level, idx, digest) of every node."""
        return reduce(DataFrame.unionByName, [
            x.select("group", F.lit(i).alias("level"), "idx", _hex(F.col("digest")).alias("digest"))
            for i, x in enumerate(self.levels)])

    def with_paths(self, tops: DataFrame) -> DataFrame:
        """The leaves with ``path``: siblings on the left and right, from the leaf to the last top.

        ``tops`` (group, path, ...) is what follows above each group's top; its further
        columns are handed down.  A level meets its parents by (group, idx), eight rows a key.
        """
        found = None
        for level in reversed(self.levels):
            at_top = level.filter("n = 1").join(tops, "group")
            if found is not None:
                step = F.array(F.struct("left", "right"))
                up = found.drop("n", "digest", "left", "right").withColumnRenamed("idx", "_parent")
                below = level.filter("n > 1").withColumn("_parent", F.floor(F.col("idx") / self.fanout)).join(up, ["group", "_parent"])
                at_top = at_top.unionByName(below.withColumn("path", F.concat(step, F.col("path"))).drop("_parent"))
            found = at_top if level is self.levels[0] else materialized(at_top, "paths")
        return found


@dataclass(frozen=True)
class Manifest:
    groups: Tree
    #: The tree over the subroots: a single group.
    roots: Tree
    #: Hex digest, None for an empty table.
    root: str | None

    @classmethod
    def build(cls, leaves: DataFrame, fanout: int = FANOUT) -> Manifest:
        """Manifest of ``leaves``: group string (null allowed), key, digest hex, other columns.

        The sort key of a group puts null first and the others in the order of their bytes.
        """
        named = leaves.withColumn("group", F.coalesce(F.concat(F.lit("="), F.col("group")), F.lit("")))
        groups = Tree.build(named.withColumn("digest", F.unhex("digest")), [F.col("key"), F.col("digest")], fanout)
        roots = Tree.build(groups.tops.select(F.lit("").alias("group"), F.col("group").alias("member"), "digest"),
                           [F.col("member")], fanout)
        top = roots.tops.select(_hex(F.col("digest"))).first()
        return cls(groups, roots, top[0] if top else None)

    def proofs(self) -> DataFrame:
        """The leaves with subroot (hex) and path; see :meth:`Tree.with_paths`."""
        nothing = F.array().cast("array<struct<left:binary,right:binary>>")
        top = self.roots.tops.select("group", nothing.alias("path"))
        above = self.roots.with_paths(top).select(
            F.col("member").alias("group"), "path", _hex(F.col("digest")).alias("subroot"))
        return self.groups.with_paths(above)


def path_digest(path: Column) -> Column:
    """Hex sha256 of all siblings on the path, from left to right and upwards."""
    return F.sha2(F.array_join(F.transform(path, lambda s: _hex(F.concat(s["left"], s["right"]))), ""), 256)


def fold(leaf_hex: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    return F.aggregate(path, leaf_hex, lambda h, s: F.sha2(F.concat(_hex(s["left"]), h, _hex(s["right"])), 256))


def verify_tampered(docs: DataFrame, every: int = 3, fanout: int = FANOUT) -> DataFrame:
    """Manifest of ``docs`` and the check of each row, some of which are tampered with.

    Where ``every`` divides the crc32 of the doc_id, the text's A-Z are lower-cased after the
    manifest was made; such a row verifies only if it had none.  A null doc_id is not
    tampered with.  Returns doc_id, leaf, subroot, root, proof_sha256, folded_root, verified:
    one row per row of ``docs``, repeated ones included.
    """
    rows = textops.documents(docs, "doc_id", "source", "lang", "n_chars", "text")
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0, F.lit(False))
    whole = lambda text: leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    leaves = rows.select(
        F.col("lang").cast("string").alias("group"), F.col("doc_id").alias("key"), whole(F.col("text")).alias("digest"),
        F.when(touched, F.unhex(whole(lower_ascii(F.col("text"))))).alias("tampered"))
    manifest = Manifest.build(leaves, fanout)
    root = F.lit(manifest.root).cast("string")
    own = _hex(F.col("digest"))
    folded = fold(F.coalesce(_hex(F.col("tampered")), own), F.col("path"))
    return manifest.proofs().select(
        F.col("key").alias("doc_id"), own.alias("leaf"), "subroot", root.alias("root"),
        path_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
