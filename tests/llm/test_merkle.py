"""The manifest against a plain tree, and what tampering does to it."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fundtide.llm import merkle

COLUMNS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(digests, fanout):
    """Root (None without leaves) and, per leaf, its (left, right) siblings on the way up."""
    if not digests:
        return None, []
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        runs = [digests[i:i + fanout] for i in range(0, len(digests), fanout)]
        for k, path in enumerate(paths):
            run, slot = runs[at[k] // fanout], at[k] % fanout
            path.append((run[:slot], run[slot + 1:]))
            at[k] //= fanout
        digests = [h(*run) for run in runs]
    return digests[0], paths


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def by_force(rows, fanout=8):
    langs = defaultdict(list)
    for row in rows:
        langs[row[2]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(langs, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(langs[g], key=lambda x: x[:3])], fanout) for g in order}
    root, tops = tree([trees[g][0] for g in order], fanout)
    found = []
    for g, top in zip(order, tops):
        for (_, _, own, row), path in zip(sorted(langs[g], key=lambda x: x[:3]), trees[g][1]):
            touched = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            folded = leaf((*row[:4], lowered(row[4]))) if touched else own
            for left, right in path + top:
                folded = h(*left, folded, *right)
            proof = h(*["".join(left + right) for left, right in path + top])
            found.append((row[0], own, trees[g][0], root, proof, folded, folded == root))
    return sorted(found, key=repr)


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def result(df, **more):
    return sorted((tuple(r) for r in merkle.verify_tampered(df, **more).collect()), key=repr)


def test_documents(documents):
    got = result(documents)
    assert got == by_force(rows_of(documents))
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("fanout, runs", [(2, 2), (3, 5)])
def test_blocks_and_fanouts(documents, monkeypatch, fanout, runs):
    monkeypatch.setattr(merkle, "RUNS", runs)  # windows of few runs, so groups span many of them
    some = documents.filter("doc_id < 75").withColumn("lang", F.when(F.col("doc_id") % 5 > 0, F.col("lang")))
    assert result(some, fanout=fanout) == by_force(rows_of(some), fanout)


def test_groups_of_all_sizes(llm_spark):
    """Each size is a group; there are more groups than a run holds, and one table of a single row, and none."""
    rows = [(100 * k + i, "s", f"l{k}", 1, f"Text {i}") for k, n in enumerate([1, 2, 7, 8, 9, 63, 64, 65, 1]) for i in range(n)]
    for some in (rows, rows[:1], []):
        df = llm_spark.createDataFrame(some or rows[:1], COLUMNS).limit(len(some))
        assert result(df) == by_force(some)


def test_odd_rows(llm_spark):
    rows = [(None, None, None, None, None), (None, "s", "en", 4, "Null id"), (7, "s", "en", 4, "Twice"), (7, "s", "en", 4, "Twice"),
            (7, "s", "en", 5, "Other"), (3, "s", "", 0, ""), (4, "", "é", 9, "X" * 300000), (-9, "ü", "z", None, "Ünï ÇÖ 漢 🙂 \x00")]
    df = llm_spark.createDataFrame(rows, COLUMNS)
    clash = df.select("*", *[F.lit(1).alias(c) for c in ("group", "idx", "digest", "_at", "_range", "n", "path", "key")])
    assert result(clash) == by_force(rows)
    manifest = merkle.Manifest.build(df.select(F.col("lang").alias("group"), F.col("doc_id").alias("key"),
                                               merkle.leaf(*[F.col(c) for c in df.columns]).alias("digest")))
    nodes = manifest.groups.nodes().collect()
    assert len([r for r in nodes if r["level"] == 0]) == len(rows) and manifest.root == by_force(rows)[0][3]
