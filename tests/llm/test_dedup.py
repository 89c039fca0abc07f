import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from fundtide.llm import graph, near_dedup, suffix_dedup, textops

from .conftest import ODD_TEXTS


def brute_repeats(texts, width):
    """Per text: bytes, removed, runs and hash of the rest, window by window."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[k:k + width] for b in raw for k in range(len(b) - width + 1))
    out = []
    for b in raw:
        cover = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if count[b[k:k + width]] > 1:
                cover[k:k + width] = b"\x01" * width
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        runs = sum(c and not (k and cover[k - 1]) for k, c in enumerate(cover))
        out.append((len(b), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    return out


def digest_rows(df, **how):
    return sorted(tuple(r)[1:] for r in suffix_dedup.digest(df, **how).collect())


def test_repeats_of_a_table(documents, corpus):
    want = dict(zip(corpus, brute_repeats(corpus.values(), 200), strict=True))
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.digest(documents.repartition(5)).collect()}
    assert got == want


def test_repeats_of_odd_rows(odd, nothing):
    assert digest_rows(odd) == sorted(brute_repeats([t for _, t in ODD_TEXTS], 200))
    assert suffix_dedup.digest(nothing).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_of_random_texts(llm_spark, seed):
    """Few letters and short windows, so that nearly everything overlaps."""
    rng = random.Random(seed)
    pieces = ["".join(rng.choices("ab", k=rng.randint(3, 30))) for _ in range(30)]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 6))) for _ in range(150)]
    df = llm_spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert digest_rows(df, width=24, gram=13) == sorted(brute_repeats(texts, 24))


def test_buckets_edges_are_compared(llm_spark, monkeypatch):
    """One group of copies holds most rows and many buckets."""
    monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", 20)
    rng = random.Random(8)
    text = "".join(rng.choices("abcdefgh", k=400))
    texts = [text] * 60 + ["".join(rng.choices("abcdefgh", k=400)) for _ in range(20)] + [text[:260] + "z" + text[261:]]
    df = llm_spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert digest_rows(df) == sorted(brute_repeats(texts, 200))


def test_long_texts_are_cut_into_slices(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 500)
    rng = np.random.default_rng(4)
    data = rng.integers(97, 123, 4000).astype(np.uint8)
    rows = suffix_dedup.segments(data, np.array([0, len(data)]), np.array([7]))
    covered = np.concatenate([np.arange(r["at"], r["at"] + r["n"]) for r in rows])
    assert np.array_equal(np.sort(covered), np.arange(len(data) - 199))


def test_multikey_quicksort_orders_by_all_tokens():
    rng = np.random.default_rng(5)
    tokens = [rng.integers(0, 9, 30000).astype(np.uint64), rng.integers(0, 2**63, 30000).astype(np.uint64) % np.uint64(50)]
    order = suffix_dedup.multikey_quicksort(tokens, leaf=64)
    assert np.array_equal(np.sort(order), np.arange(30000))
    pairs = list(zip(tokens[0][order].tolist(), tokens[1][order].tolist(), strict=True))
    assert pairs == sorted(pairs)


def test_rows_go_where_the_splitters_say():
    rng = np.random.default_rng(6)
    rows = np.zeros(3000, suffix_dedup._SUFFIX)
    for name in ("t0", "t1", "key", "at"):
        rows[name] = rng.integers(0, 4, 3000)
    splitters = suffix_dedup.splitters_of(rows[:400], 12)
    place = suffix_dedup.route(rows, splitters)
    as_tuple = lambda r: tuple(int(r[c]) for c in ("t0", "t1", "key", "at"))
    assert place.tolist() == [sum(as_tuple(s) <= as_tuple(r) for s in splitters) for r in rows]


def test_cut_texts_keep_the_columns(odd, documents, corpus):
    kept = suffix_dedup.remove_repeats(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD_TEXTS)
    sizes = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.digest(documents).collect()}
    for r in suffix_dedup.remove_repeats(documents).collect():
        assert r["n_chars"] == len(r["text"])
        assert (r["text"] == corpus[r["doc_id"]]) == (sizes[r["doc_id"]] == 0)


def word_shingles(text):
    words = (text or "").split()
    if not words:
        return Counter()
    return Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)])


def probability_jaccard(a, b):
    if not a or not b:
        return float(not a and not b)
    return sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in a | b) for d in a if b[d])


def brute_classes(texts):
    sets = {k: word_shingles(t) for k, t in texts.items()}
    lead = {k: k for k in texts}

    def root(x):
        while lead[x] != x:
            x = lead[x]
        return x

    where = defaultdict(set)
    for k, s in sets.items():
        for x in s or ["none"]:
            where[x].add(k)
    pairs = {tuple(sorted((a, b))) for ks in where.values() for a in ks for b in ks if a < b}
    for a, b in pairs:
        if root(a) != root(b) and probability_jaccard(sets[a], sets[b]) >= near_dedup.THRESHOLD:
            lead[max(root(a), root(b))] = min(root(a), root(b))
    return {k: root(k) for k in texts}


def test_near_classes_of_a_table(documents, corpus):
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(documents.repartition(4)).collect()}
    assert got == brute_classes(corpus)


def test_near_classes_of_a_group_with_many_variants(llm_spark):
    """Edits of one base text: some pairs are near, some only through others."""
    rng = random.Random(9)
    base = [f"w{rng.randint(0, 500)}" for _ in range(150)]
    texts = {}
    for k in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = f"e{rng.randint(0, 9999)}"
        texts[k] = " ".join(words)
    texts |= {100 + k: " ".join(f"w{rng.randint(0, 500)}" for _ in range(80)) for k in range(20)}
    df = llm_spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {r["doc_id"]: r["class_id"] for r in near_dedup.classes(df).collect()} == brute_classes(texts)


def test_near_classes_of_odd_rows(odd, nothing):
    rows = near_dedup.classes(odd).collect()
    assert len(rows) == len(ODD_TEXTS)
    by_id = {r["doc_id"]: r["class_id"] for r in rows}
    assert by_id[1] == by_id[2] == by_id[3] == 1 and by_id[4] == by_id[5] == 4 and by_id[None] is None
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({str(c) for c in by_id.values()})
    assert near_dedup.classes(nothing).count() == 0 and near_dedup.keep_one(nothing).count() == 0


def test_signatures_estimate_the_index():
    rng = np.random.default_rng(10)
    a = Counter(rng.integers(0, 300, 900).tolist())
    b = Counter({k: v + int(k % 3 == 0) for k, v in a.items() if k % 5})
    sets = [(np.array(sorted(s)), np.array([s[k] for k in sorted(s)])) for s in (a, b)]
    exact = near_dedup.similarity(*sets[0], *sets[1])
    assert exact == pytest.approx(probability_jaccard(a, b))
    owner = np.repeat([0, 1], [len(sets[0][0]), len(sets[1][0])])
    hashes = textops.mix(np.concatenate([s[0] for s in sets]).astype(np.uint64) + np.uint64(77))
    signature = near_dedup.signatures(owner, hashes, np.concatenate([s[1] for s in sets]), 2, registers=6000)
    assert (signature[0] == signature[1]).mean() == pytest.approx(exact, abs=0.03)


def test_components(llm_spark):
    rng = random.Random(11)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)]
    lead = {}

    def root(x):
        while lead.setdefault(x, x) != x:
            x = lead[x]
        return x

    for a, b in edges:
        lead[max(root(a), root(b))] = min(root(a), root(b))
    got = graph.components(llm_spark.createDataFrame(edges, "a bigint, b bigint"))
    want = {x: root(x) for e in edges for x in e if e[0] != e[1]}
    assert {r["id"]: r["component"] for r in got.collect()} == want
