"""Spelling variants: words one edit apart, grouped under their most frequent form.

The dictionary is a pair of tries.  Every word is a path of prefix nodes in the trie of the
words and a path of suffix nodes in the trie of the reversed words; the nodes are numbered,
so a prefix and a suffix are one integer each.  At position i of a word

* the pair (prefix before i, suffix from i) is the word itself, split;
* the pair (prefix before i, suffix after i) is the word with the character at i skipped.

Equal pairs of two words that skip a character are one replacement; a split word that equals
a pair which skips one is one insertion or deletion.  The join on pairs of integers is exact.
A pair has at most one split word and one skipping word per character of the alphabet
(26 + 64), so its group is small whatever the data; what is counted and compared in it goes
on per word, without a table of links.

Nodes are numbered from sorted words: a word opens a node for each character beyond what it
shares with its predecessor.  The words are range-partitioned; of each range only the first
and last word go to the driver, which names the nodes that reach over its borders.
"""

from __future__ import annotations

import os.path
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtide.llm import merkle, textops
from fundtide.sources.workspace import materialized

#: Letters a word is made of.
LETTERS = "([A-Za-zÀ-ÿ]+)"
#: Words in one range of the sorted dictionary.
RANGE_WORDS = 100_000

_LOCAL_BITS = 36
_BORDER_BITS = 31


def vocabulary(docs: DataFrame, damage: int = 199, least_length: int = 6, least_n: int = 5) -> DataFrame:
    """(word, n) of the letter runs of all texts, A-Z lower-cased.

    Where ``damage`` divides h, the crc32 of ``<doc_id>:<run>``, the run loses the code point
    at h modulo its length.  Words have at least ``least_length`` code points and ``least_n``
    occurrences.  Null texts have no words; a null doc_id is written as nothing.
    """
    rows = textops.documents(docs, "doc_id", "text")
    run = rows.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(
        F.regexp_extract_all("text", F.lit(LETTERS), F.lit(1))).alias("run")).withColumn("run", merkle.lower_ascii(F.col("run")))
    # A damaged run is one character shorter, so nothing shorter than a word can become one.
    run = run.withColumn("size", F.char_length("run")).filter(F.col("size") >= least_length)
    run = run.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.col("size")).cast("int")
    left = F.col("run").substr(F.lit(1), at)
    right = F.col("run").substr(at + 2, F.col("size"))
    word = F.when(F.col("h") % damage == 0, F.concat(left, right)).otherwise(F.col("run"))
    found = run.select(word.alias("word")).filter(F.char_length("word") >= least_length)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_n)


def _borders(first_last: list[tuple[int, str, str]]) -> dict[int, tuple[tuple[str, list[int]], ...]]:
    """Per range: the prefixes it shares with the range before and after, with their node numbers.

    A node that reaches over several borders has the number of the first.
    """
    found: dict[int, list[tuple[str, list[int]]]] = {part: [] for part, _, _ in first_last}
    shared, numbers = "", []
    for k in range(1, len(first_last)):
        (before, _, last), (after, first, _) = first_last[k - 1], first_last[k]
        prefix = os.path.commonprefix([last, first])
        known = min(len(os.path.commonprefix([shared, prefix])), len(numbers))
        numbers = numbers[:known] + [-((k << _BORDER_BITS) + d) for d in range(known + 1, len(prefix) + 1)]
        shared = prefix
        found[before].append((prefix, numbers))
        found[after].append((prefix, numbers))
    return {part: tuple(pairs) for part, pairs in found.items()}


def _path(word: str, borders: tuple[tuple[str, list[int]], ...]) -> list[int]:
    """Numbers of the word's nodes that reach over a border."""
    best: list[int] = []
    for prefix, numbers in borders:
        size = len(os.path.commonprefix([word, prefix]))
        if size > len(best):
            best = numbers[:size]
    return best


def nodes_of(keys: list[str], part: int, borders: tuple[tuple[str, list[int]], ...]) -> Iterator[list[int]]:
    """Node numbers of the prefixes of sorted ``keys``, one list per key."""
    before, path, opened = "", [], part << _LOCAL_BITS
    for key in keys:
        over = _path(key, borders)
        same = len(os.path.commonprefix([before, key]))
        kept = path[:same]
        if len(over) > same:  # nodes known from a border, not from the predecessor
            kept = over
        new = len(key) - len(kept)
        path = kept + list(range(opened + 1, opened + new + 1))
        opened += new
        before = key
        yield path


_FORWARD = "id bigint, key string, n bigint, nodes array<bigint>, fresh array<boolean>"


def _numbered(table: DataFrame) -> DataFrame:
    """``table`` (key, n and maybe id) with the trie nodes of the keys' prefixes, by range.

    Without an id, a key's place in the order is given: range, then position in it.  ``fresh``
    marks the characters that differ from the one before.
    """
    named = "id" in table.columns
    spark = table.sparkSession
    count = table.count()
    parts = max(-(-count // RANGE_WORDS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = materialized(
        table.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id()), "ranges")
    # Two keys per range.
    ends = ranged.groupBy("part").agg(F.min("key"), F.max("key")).collect()
    borders = _borders(sorted((r[0], r[1], r[2]) for r in ends))

    def number(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        group = group.sort_by("key")  # by bytes, as Spark does
        keys = group.column("key").to_pylist()
        ids = group.column("id") if named else pa.array(range(part << _LOCAL_BITS, (part << _LOCAL_BITS) + len(keys)), pa.int64())
        fresh = [[i == 0 or c != key[i - 1] for i, c in enumerate(key)] for key in keys]
        return pa.table({
            "id": ids, "key": group.column("key"), "n": group.column("n"),
            "nodes": pa.array(list(nodes_of(keys, part, borders[part])), pa.list_(pa.int64())),
            "fresh": pa.array(fresh, pa.list_(pa.bool_()))})

    return ranged.groupBy("part").applyInArrow(number, _FORWARD)


def pairs(words: DataFrame) -> DataFrame:
    """(p, s, kind, id, n): every split (kind 2) and skipping pair of nodes of ``words`` (id, n, fore, back, fresh).

    A skipping pair has kind 1 at the first of equal characters in a row, else 0: skipping any
    of them gives the same word, so only the first may stand for a deletion.
    """
    root = F.array(F.lit(0).cast("bigint"))
    fore, back, m = F.concat(root, "fore"), F.concat(root, "back"), F.size("fore")
    split = words.select("id", "n", F.explode(F.arrays_zip(fore.alias("p"), F.reverse(back).alias("s"))).alias("at"))
    skip = words.select("id", "n", F.explode(F.arrays_zip(
        F.slice(fore, 1, m).alias("p"), F.reverse(F.slice(back, 1, m)).alias("s"), F.col("fresh").alias("fresh"))).alias("at"))
    return split.select("at.p", "at.s", F.lit(2).alias("kind"), "id", "n").unionByName(
        skip.select("at.p", "at.s", F.col("at.fresh").cast("int").alias("kind"), "id", "n"))


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, best): neighbours of a word one edit away, and struct(n, -id) of the best one."""
    met = pairs(words).groupBy("p", "s").agg(F.collect_list(F.struct("kind", "id", "n")).alias("met")).filter(F.size("met") > 1)

    def around(x):
        near = lambda y: (y["id"] != x["id"]) & (
            ((x["kind"] < 2) & (y["kind"] < 2)) | (x["kind"] + y["kind"] == 3))
        others = F.filter("met", near)
        return F.struct(x["id"].alias("id"), F.size(others).alias("near"), F.array_max(F.transform(
            others, lambda y: F.struct(y["n"].alias("n"), (-y["id"]).alias("minus")))).alias("best"))

    seen = met.select(F.explode(F.transform("met", around)).alias("x")).select("x.*").filter("near > 0")
    return seen.groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root): the end of the chain id -> form.

    A form has several times the occurrences, so chains are short; each turn doubles the step.
    """
    reached = materialized(forms.select("id", F.col("form_id").alias("root")), "roots")
    while True:
        ahead = reached.select(F.col("id").alias("root"), F.col("root").alias("next"))
        step = materialized(reached.join(ahead, "root", "left").select("id", F.coalesce("next", "root").alias("root"),
                                                                        F.col("next").isNotNull().alias("moved")), "roots")
        reached = step.select("id", "root")
        if step.filter("moved").isEmpty():
            return reached


def variants(vocabulary: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of ``vocabulary`` (word, n).

    Near words differ by one inserted, deleted or replaced code point.  The form is the near
    word of largest n (ties: the first in code-point order), if it has at least ``ratio`` times
    the occurrences; the root is where following forms ends.  Words are distinct and not null;
    an empty vocabulary gives no rows.
    """
    # Ranges are cut from a sample of the words, so they are read twice.
    vocabulary = materialized(vocabulary.select(F.col("word").alias("key"), "n"), "vocabulary")
    fore = materialized(_numbered(vocabulary), "fore")
    back = _numbered(fore.select(F.reverse("key").alias("key"), "n", "id")).select("id", F.col("nodes").alias("back"))
    words = materialized(fore.withColumnRenamed("nodes", "fore").join(back, "id"), "nodes").withColumnRenamed("key", "word")
    near = neighbours(words)
    known = words.select("id", "word", "n").join(near, "id", "left")
    big = F.col("best")["n"] >= ratio * F.col("n")
    known = materialized(known.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(big, -F.col("best")["minus"]).alias("form_id"), F.when(big, F.col("best")["n"]).alias("form_n")), "near")
    # Only words that have a form are looked up.
    formed = known.filter("form_id IS NOT NULL")
    names = known.select(F.col("id").alias("other"), F.col("word").alias("name"))
    ends = formed.join(_roots(formed), "id").join(names, F.col("form_id") == F.col("other")).withColumnRenamed("name", "form").drop("other")
    ends = ends.join(names, F.col("root") == F.col("other")).select("word", "form", F.col("name").alias("root"), "n", "n_near", "form_n")
    alone = known.filter("form_id IS NULL").select(
        "word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return ends.unionByName(alone)
