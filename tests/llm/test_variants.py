"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from fundtide.llm import variants


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def by_force(counts, ratio=5):
    rows, form = {}, {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
        rows[w] = [n, len(near)]
    found = set()
    for w, (n, near) in rows.items():
        root = w
        while form[root] is not None:
            root = form[root]
        found.add((w, form[w], root, n, near, counts[form[w]] if form[w] is not None else None))
    return found


def counted_by_force(rows, damage=199, least_length=6, least_n=5):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % damage == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= least_length:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= least_n}


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()) or [("", 0)], "word string, n bigint").limit(len(counts))


@pytest.mark.parametrize("seed, alphabet, most", [(1, "ab", 7), (2, "abÀÿ", 5), (3, "aabéz", 9)])
def test_neighbours_forms_and_roots(llm_spark, monkeypatch, seed, alphabet, most):
    monkeypatch.setattr(variants, "RANGE_WORDS", 7)  # many ranges, so many nodes reach over borders
    rng = random.Random(seed)
    counts = {"".join(rng.choices(alphabet, k=rng.randint(1, most))): rng.choice([1, 1, 2, 5, 5, 30, 200, 4000]) for _ in range(220)}
    got = {tuple(r) for r in variants.variants(frame(llm_spark, counts)).collect()}
    assert got == by_force(counts)


def test_long_chain_and_long_words(llm_spark):
    chain = {"w" + "x" * k + "yyyyyy": 6 ** (9 - k) for k in range(9)}  # each is the form of the next
    long = {"q" * 30000 + "a": 5, "q" * 30000 + "b": 50, "q" * 30001 + "b": 5, "alone": 7}
    counts = chain | long
    got = {tuple(r) for r in variants.variants(frame(llm_spark, counts)).collect()}
    assert {r[2] for r in got if r[0] in chain} == {"wyyyyyy"}
    want = by_force(chain) | by_force({"alone": 7})
    want |= {("q" * 30000 + "a", "q" * 30000 + "b", "q" * 30000 + "b", 5, 1, 50), ("q" * 30000 + "b", None, "q" * 30000 + "b", 50, 2, None),
             ("q" * 30001 + "b", "q" * 30000 + "b", "q" * 30000 + "b", 5, 1, 50)}
    assert got == want


def test_vocabulary_deletes_by_hash(llm_spark, documents, corpus):
    for damage in (199, 3):
        got = {r["word"]: r["n"] for r in variants.vocabulary(documents, damage).collect()}
        assert got == counted_by_force(corpus.items(), damage)


def test_odd_rows(odd, nothing):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = {r["word"]: r["n"] for r in variants.vocabulary(odd, 2, 3, 1).collect()}
    assert got == counted_by_force(rows, 2, 3, 1)
    assert {tuple(r) for r in variants.variants(variants.vocabulary(odd, 2, 3, 1)).collect()} == by_force(got)
    assert variants.variants(variants.vocabulary(nothing)).collect() == []
