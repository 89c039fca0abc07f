import io
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from fundtide.llm import packing, textops, token_files, tokenizing  # noqa: E402

from .conftest import ODD_TEXTS  # noqa: E402

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


@pytest.mark.parametrize("name", FILES)
def test_parts_give_the_ids_of_the_library(name, corpus):
    encoder = tokenizing.Encoder(public_tokenizers.path(name))
    rng = random.Random(3)
    alphabet = "ab's'S  \n\t\r.,!é×÷ ²½ªIİ0129çñ¿«»\x0b漢́\x00"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 14))) for _ in range(4000)]
    texts += ["it's  they're\n\n we'll '' 's'se 'tis", "", "  ", "\n", "a\n \nb", "a  b ", "<|endoftext|> a"]
    texts += list(corpus.values())[:60]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    seen = 0
    for part in textops.chunks([batch], limit=1 << 14):
        ids, at = encoder.encode(*textops.utf8(part.column("text")))
        for i, text in enumerate(part.column("text").to_pylist()):
            assert np.array_equal(ids[at[i]:at[i + 1]], encoder.whole(text)), text
            seen += 1
    assert seen == len(texts)


ADDED = [
    "Models end with <|endoftext|> here.", "<|endoftext|>", "<|ENDOFTEXT|>", "", "a <|endof", "text|> b", "<|startoftext|>a b",
    "漢 <|ENDOFTEXT|>", "漢 <|endoftext|>", "漢 <|EndOfText|>", "x<|endoftext|><|endoftext|>  y", "<|endoftext|", "plain text  here",
    " <|endoftext|> ", "PLAIN <|endoftext|> It's", "plain <|endoftext|> it's",
]


@pytest.mark.parametrize("name", FILES)
def test_added_tokens_are_found_as_by_the_library(name):
    from tokenizers import Tokenizer

    library, encoder = Tokenizer.from_file(public_tokenizers.path(name)), tokenizing.Encoder(public_tokenizers.path(name))
    for texts in (ADDED, ADDED[::-1], [t for t in ADDED for _ in range(2)], *[[t] for t in ADDED]):
        ids, at = encoder.encode(*textops.utf8(pa.array(texts)))
        for i, text in enumerate(texts):
            assert ids[at[i]:at[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert len(library.encode(ADDED[1], add_special_tokens=False).ids) == 1


def test_tables_with_added_tokens(llm_spark):
    from tokenizers import Tokenizer

    docs = llm_spark.createDataFrame(list(enumerate(ADDED)), "doc_id bigint, text string")
    lone = [Tokenizer.from_file(public_tokenizers.path(name)) for name in FILES]
    start = 0
    for row in sorted(token_files.token_file_digest(docs, public_tokenizers.path(FILES[0])).collect()):
        ids = np.array([*lone[0].encode(ADDED[row["doc_id"]], add_special_tokens=False).ids, 2], "<u4")
        assert tuple(row) == (row["doc_id"], start, len(ids), zlib.crc32(ids))
        start += len(ids)
    for row in packing.pack_documents(docs, public_tokenizers.path(FILES[1])).collect():
        ids = np.array([*lone[1].encode(ADDED[row["doc_id"]], add_special_tokens=False).ids, 0], "<u4")
        assert (row["length"], row["ids_crc32"]) == (len(ids), zlib.crc32(ids))


def test_the_table_of_parts_stays_bounded(monkeypatch):
    monkeypatch.setattr(tokenizing, "ENTRIES", 10)
    table = tokenizing._Table()
    for k in range(100):
        table.add(k, b"x")
        assert len(table) <= 10 and len(table._old) <= 10
    assert table.old(85) == b"x" and table.old(1) is None


@pytest.mark.parametrize("ids", [
    np.zeros(1, np.uint32), np.full(77, 9, np.uint32), np.arange(5000, dtype=np.uint32),
    np.array([3, 5, 2**32 - 1, 4, 4, 4] * 50, np.uint32),
    np.random.default_rng(1).geometric(0.001, 9000).astype(np.uint32),
])
def test_blocks_come_back(ids):
    buffer = io.BytesIO()
    at = 0
    for k in range(0, len(ids), 1000):
        buffer.write(token_files.pack_block(ids[k:k + 1000]))
    parts = []
    while at < len(buffer.getvalue()):
        block, at = token_files.unpack_block(buffer.getvalue(), at)
        parts.append(block)
    assert np.array_equal(np.concatenate(parts), ids)


def test_outliers_do_not_widen_a_block():
    ids = np.array([7, 8, 9, 10] * 500, np.uint32)
    plain = len(token_files.pack_block(ids))
    ids[13] = 40000
    assert len(token_files.pack_block(ids)) <= plain + 6


def test_shards_give_ranges_of_ids(tmp_path):
    from pyarrow import fs

    ids = np.random.default_rng(2).integers(0, 49408, 10000).astype(np.uint32)
    local = fs.LocalFileSystem()
    writer = token_files.ShardWriter(local.open_output_stream(str(tmp_path / "a")))
    writer.add(np.array([4, 9]), np.array([9000, 1000]), ids)
    writer.close()
    with local.open_input_file(str(tmp_path / "a")) as file:
        reader = token_files.ShardReader(file)
        for a, b in [(0, 10000), (4095, 4097), (8191, 9999), (5, 5)]:
            assert np.array_equal(reader.ids(a, b), ids[a:b])
        assert [r[:3] for r in reader.documents()] == [(4, 0, 9000), (9, 9000, 1000)]
    (tmp_path / "b").write_bytes(b"PFORIDS1 but no more" * 4)
    with local.open_input_file(str(tmp_path / "b")) as file, pytest.raises(ValueError):
        token_files.ShardReader(file)


def test_token_files_of_a_table(llm_spark, documents, corpus):
    path = public_tokenizers.path(FILES[0])
    rows = sorted(token_files.token_file_digest(documents.repartition(7), path).collect(), key=lambda r: r["doc_id"])
    encoder, start = tokenizing.Encoder(path), 0
    for row, (doc_id, text) in zip(rows, sorted(corpus.items()), strict=True):
        ids = np.append(encoder.whole(text), 2).astype("<u4")
        assert tuple(row) == (doc_id, start, len(ids), zlib.crc32(ids))
        start += len(ids)


def test_token_files_of_odd_rows(odd, nothing):
    path = public_tokenizers.path(FILES[0])
    rows = token_files.token_file_digest(odd.unionByName(odd).repartition(5), path).collect()
    encoder, start = tokenizing.Encoder(path), 0
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])] == sorted(
        [d for d, _ in ODD_TEXTS] * 2, key=lambda d: (d is not None, d))
    want = sorted((d or -1, zlib.crc32(np.append(encoder.whole(t or ""), 2).astype("<u4"))) for d, t in ODD_TEXTS * 2)
    assert sorted((r["doc_id"] or -1, r["ids_crc32"]) for r in rows) == want
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert token_files.token_file_digest(nothing, path).count() == 0


def test_token_files_know_their_file_system(llm_spark, tmp_path):
    assert token_files.located(llm_spark, str(tmp_path)) == f"file://{tmp_path}"
    assert token_files.located(llm_spark, f"file://{tmp_path}") == f"file://{tmp_path}"
    with pytest.raises(ValueError, match="cannot be written"):
        token_files.located(llm_spark, "http://127.0.0.1/somewhere")


def check_packing(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_sequence)


def test_packing_of_a_table(documents, corpus):
    path = public_tokenizers.path(FILES[1])
    rows = packing.pack_documents(documents, path).collect()
    used = check_packing(rows, packing.CAPACITY)
    assert used <= math.ceil(sum(r["length"] for r in rows) / packing.CAPACITY) + 1
    encoder = tokenizing.Encoder(path)
    for doc_id, text in corpus.items():
        ids = np.append(encoder.whole(text), 0).astype("<u4")
        own = sorted((r for r in rows if r["doc_id"] == doc_id), key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(-(-len(ids) // packing.CAPACITY)))
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]])
        assert all(r["length"] == packing.CAPACITY for r in own[1:])


def test_packing_of_odd_rows(odd, nothing):
    path = public_tokenizers.path(FILES[1])
    rows = packing.pack_documents(odd, path).collect()
    check_packing(rows, packing.CAPACITY)
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert sum(r["piece"] == 0 for r in rows) == len(ODD_TEXTS)
    assert packing.pack_documents(nothing, path).count() == 0


def test_plans_hold_every_piece_and_are_tight():
    rng = random.Random(5)
    for capacity, most in [(10, 4), (64, 30), (2048, 200)]:
        histogram = {k: rng.randint(1, most) for k in rng.sample(range(1, capacity + 1), min(capacity, 120))}
        patterns = packing.plan(histogram, capacity, steps=80)
        held = {}
        for p in patterns:
            assert sum(k * n for k, n in p.items) <= capacity
            for k, n in p.items:
                held[k] = held.get(k, 0) + n * p.copies
        assert held == histogram
        bound = math.ceil(sum(k * v for k, v in histogram.items()) / capacity)
        large = sum(v for k, v in histogram.items() if 2 * k > capacity)
        assert sum(p.copies for p in patterns) <= max(bound, large) * 1.1 + 2


def test_exact_optimum_on_a_known_case():
    assert sum(p.copies for p in packing.plan({6: 2, 4: 2, 5: 4}, 10)) == 4
    with pytest.raises(ValueError):
        packing.plan({11: 1}, 10)
