import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from fundtide.llm import decontamination, queries, revisits, textops

from .conftest import SF

QUERY_TABLES = ("documents", "pages", "benchmark", "labels")


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 20))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontamination.common_subsequence(a, b) == table[-1][-1]


@pytest.fixture(scope="module")
def benchmark(llm_spark):
    return llm_spark.read.parquet(f"{SF}/benchmark.parquet")


def words(text):
    return decontamination.word_hashes(*textops.utf8(pa.array([text])))[0].tolist()


def test_items_in_a_table(documents, corpus, benchmark):
    """Every document that holds an item word by word is found; every other match has most of its words in order."""
    items = {r["item_id"]: r["text"] for r in benchmark.collect()}
    got = {(r["doc_id"], r["item_id"]): r for r in decontamination.matches(
        documents, decontamination.Index.build(documents, benchmark)).collect()}
    hold = {(d, i) for d, t in corpus.items() for i, item in items.items() if item in t}
    assert hold <= set(got)
    for (d, i), r in got.items():
        item = words(items[i])
        assert decontamination.common_subsequence(item, words(corpus[d])) >= 0.6 * len(item)
        assert r["lcs_share"] >= decontamination.PARAPHRASE_SHARE


def test_copies_and_paraphrases_anywhere_in_long_texts(llm_spark, documents, corpus, benchmark):
    rng = random.Random(2)
    items = [(r["item_id"], r["text"]) for r in benchmark.collect() if len(r["text"].split()) >= 20]
    filler = " ".join(corpus.values()).split()
    rows, want = [], set()
    for k, (item, text) in enumerate(items[:25]):
        copy = text.split()
        if k % 2:  # every seventh word replaced
            copy = [w if j % 7 else "zzz" for j, w in enumerate(copy)]
        own = [rng.choice(filler) for _ in range(rng.randint(0, 600))]
        at = rng.randint(0, len(own))
        rows.append((5000 + k, " ".join(own[:at] + copy + own[at:])))
        want.add((5000 + k, item))
    clean = [(7000 + k, " ".join(rng.choice(filler) for _ in range(400))) for k in range(60)]
    docs = llm_spark.createDataFrame(rows + clean, "doc_id bigint, text string")
    index = decontamination.Index.build(documents.select("doc_id", "text").unionByName(docs), benchmark)
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.matches(docs, index).collect()}
    assert want <= got
    assert not {d for d, _ in got if d >= 7000}


def test_more_items_than_the_basis_has_room_for(llm_spark, corpus, monkeypatch):
    """Copies are found however small a part of the items the basis holds."""
    monkeypatch.setattr(decontamination, "RANK_MOST", 24)
    rng = random.Random(7)
    filler = " ".join(corpus.values()).split()
    texts = [" ".join(rng.choice(filler) for _ in range(rng.randint(15, 59))) for _ in range(600)]
    around = [[rng.choice(filler) for _ in range(120)] for _ in texts]
    rows = [(k, " ".join([*a[:k % 120], t, *a[k % 120:]])) for k, (t, a) in enumerate(zip(texts, around, strict=True))]
    clean = [(1000 + k, " ".join(rng.choice(filler) for _ in range(200))) for k in range(100)]
    docs = llm_spark.createDataFrame(rows + clean, "doc_id bigint, text string")
    index = decontamination.Index.build(docs, llm_spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string"))
    assert len(index.by_basis) < len(texts)
    got = {(r["doc_id"], r["item_id"]): r for r in decontamination.matches(docs, index).collect()}
    assert set(got) == {(k, k) for k in range(len(texts))}
    assert all(r["lcs_share"] == 1.0 and r["cosine"] >= decontamination.MIN_COSINE for r in got.values())
    assert decontamination.without_items(docs, index).count() == len(clean)


def test_frequency_counts_half_passages(llm_spark):
    texts = ["so " * 100 + "it goes", "so it goes " * 9, "", None, "it"]
    items = decontamination.Items([0], [np.array(words("so it goes"), np.uint64)], [])
    features = decontamination.Features.of(items)
    docs = llm_spark.createDataFrame([(t,) for t in texts], "text string")
    frequency, n = decontamination.document_frequency(docs, features)
    assert frequency[features(items.words[0])].tolist() == [5 + 2, 1 + 2 + 1, 1 + 2] and n == 5 + 2 + 1


def test_long_items(llm_spark, documents, corpus):
    """The copy of an item is found whatever its length, though no passage is near to all of it."""
    rng = random.Random(9)
    filler = sorted(set(" ".join(corpus.values()).split()))
    texts = [" ".join(rng.sample(filler, n)) for n in (40, 90, 100, 200, 400, 900, 1500, 2500) for _ in range(3)]
    rows = [(9000 + k, " ".join([*rng.choices(filler, k=70), t, *rng.choices(filler, k=70)])) for k, t in enumerate(texts)]
    docs = llm_spark.createDataFrame(rows, "doc_id bigint, text string")
    items = llm_spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    index = decontamination.Index.build(documents.select("doc_id", "text").unionByName(docs), items)
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.matches(docs, index).collect()}
    assert got == {(9000 + k, k) for k in range(len(texts))}


def test_rare_words_find_every_stretch_that_can_pass():
    rng = random.Random(8)
    texts = [" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(1, 30))) for _ in range(60)]
    items = decontamination.Items(list(range(60)), [decontamination.word_hashes(*textops.utf8(pa.array([t])))[0] for t in texts], [])
    chosen = np.arange(0, 60, 2)
    rare = decontamination.RareWords.of(items, chosen, lambda w: w % np.uint64(7))
    docs = [" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(0, 90))) for _ in range(40)] + texts
    data, offsets = textops.utf8(pa.array(docs))
    hashes, doc = decontamination.word_hashes(data, offsets)
    bounds = np.searchsorted(doc, np.arange(len(offsets)))
    for limit in (1 << 22, 50):
        decontamination_limit, decontamination.PAIRS_AT_A_TIME = decontamination.PAIRS_AT_A_TIME, limit
        try:
            regions = list(zip(*(c.tolist() for c in rare.regions(hashes, doc, bounds)), strict=True))
        finally:
            decontamination.PAIRS_AT_A_TIME = decontamination_limit
        for begin, end, k in regions:
            assert k in chosen and doc[begin] == doc[end - 1]
        for k in chosen.tolist():
            item, reach = items.words[k].tolist(), int(rare.reach[k])
            own = [(b, e) for b, e, i in regions if i == k]
            for d in range(len(docs)):
                for at in range(bounds[d], bounds[d + 1]):
                    stretch = hashes[at:min(at + reach, bounds[d + 1])].tolist()
                    if decontamination.common_subsequence(item, stretch) >= decontamination.PARAPHRASE_SHARE * len(item):
                        assert any(b <= at and at + len(stretch) <= e for b, e in own) or any(
                            b < at + len(stretch) and at < e and decontamination.common_subsequence(
                                item, hashes[max(b, at):min(e, at + len(stretch))].tolist())
                            >= decontamination.PARAPHRASE_SHARE * len(item) for b, e in own)


def test_matches_of_odd_rows(odd, nothing, documents, benchmark):
    index = decontamination.Index.build(documents, benchmark)
    assert decontamination.matches(odd, index).count() == 0
    assert decontamination.without_items(odd, index).count() == odd.count()
    assert decontamination.matches(nothing, index).count() == 0
    for empty in (benchmark.limit(0), benchmark.selectExpr("item_id", "'' AS text", "1 AS doc_id")):
        assert decontamination.Index.build(documents, empty) is None
    assert decontamination.matches(odd, None).count() == 0
    assert decontamination.without_items(odd, None).count() == odd.count()
    assert decontamination.Index.build(nothing, benchmark) is not None


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in QUERY_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    return connection


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_same_as_sql(llm_spark, con, key):
    result = con.execute(queries.ORACLES[key])
    names = [c[0] for c in result.description]
    want = sorted((dict(zip(names, r, strict=True)) for r in result.fetchall()), key=repr)
    got = sorted(({n: r[n] for n in names} for r in queries.QUERIES[key](llm_spark, SF).collect()), key=repr)
    assert got == want and want


@pytest.mark.parametrize("url, want", [
    ("http://www.Example.com:80/a/?b=2&utm_source=x&a=1#top", "example.com/a?a=1&b=2"),
    ("https://example.com/a/?ref=z", "example.com/a"), ("HTTPS://example.com", "example.com"), (None, None), ("", ""),
    ("http://example.com/A?x=1&x=1", "example.com/A?x=1&x=1"),
])
def test_canonical_urls(llm_spark, url, want):
    from pyspark.sql import functions as F

    row = llm_spark.createDataFrame([(url,)], "url string").select(revisits.canonical_url(F.col("url")).alias("u")).first()
    assert row["u"] == want


RECORD = ("record_id bigint, url string, captured_at bigint, record_type string, status int, "
          "headers map<string,string>, payload_digest string")


def test_revisits_by_hand(llm_spark):
    full = lambda i, at, tag, **more: (i, "http://a.b/x", at, "response", 200, {"etag": tag, "content-type": "t", **more}, f"d{i}")
    again = lambda i, at, headers, url="http://a.b/x": (i, url, at, "revisit", 304, headers, None)
    rows = [
        full(1, 10, '"p"'), full(2, 20, '"q"', vary="v"), full(3, 20, '"r"'), (4, "http://a.b/x", 25, "response", 404, {}, "d4"),
        again(10, 5, {"etag": '"p"'}), again(11, 10, {"etag": '"p"'}), again(12, 20, {"etag": 'W/"p"', "content-type": "no"}),
        again(13, 30, {"etag": '"r"', "vary": "w"}), again(14, 30, {"etag": '"q"'}), again(15, 30, {}),
        again(16, 30, None), again(17, 30, {"etag": '"r"'}, "http://other/"), again(18, 30, {"etag": '"r"'}, None),
    ]
    for slices in (1, 3, 64):
        got = {r["record_id"]: r for r in revisits.resolve(llm_spark.createDataFrame(rows, RECORD), slices).collect()}
        assert {k: (r["outcome"], r["refers_to"]) for k, r in got.items()} == {
            10: ("no_earlier_response", None), 11: ("no_earlier_response", None), 12: ("resolved", 1), 13: ("resolved", 3),
            14: ("validator_mismatch", 3), 15: ("no_validator", 3), 16: ("no_validator", 3),
            17: ("no_earlier_response", None), 18: ("no_earlier_response", None)}
        assert got[12]["headers"] == {"etag": 'W/"p"', "content-type": "t"} and got[12]["payload_digest"] == "d1"
        assert got[13]["headers"] == {"etag": '"r"', "vary": "w", "content-type": "t"}


def test_revisits_of_one_hot_url_and_none(llm_spark):
    rng = random.Random(4)
    rows = [(k, "http://hot/", rng.randint(0, 400), rng.choice(["response", "revisit"]), 200, {}, None) for k in range(500)]
    df = llm_spark.createDataFrame(rows, RECORD)
    got = {r["record_id"]: r["refers_to"] for r in revisits.resolve(df).collect()}
    for k, _, at, kind, *_ in rows:
        if kind == "revisit":
            best = max(((t, i) for i, _, t, c, *_ in rows if c == "response" and t < at), default=(None, None))
            assert got[k] == best[1]
    assert revisits.resolve(df.limit(0)).count() == 0
    doubled = revisits.resolve(df.unionByName(df))
    assert doubled.count() == 2 * len(got)


def test_pipeline(llm_spark, corpus):
    import corpus_pipeline

    docs = llm_spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {d: t for d, t in corpus.items()}
    from fundtide.sources.workspace import materialized

    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialized(stage(llm_spark, docs, SF), name)
        rows = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns == columns and set(rows) <= set(seen)
        if name != "suffix_dedup":
            assert all(seen[d] == t for d, t in rows.items())
        seen = rows
    last = corpus_pipeline.STAGES[-1][1](llm_spark, docs, SF).collect()
    assert {r["doc_id"] for r in last} == set(seen)
