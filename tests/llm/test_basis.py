"""The basis is that of the passages of all documents, however many there are."""

import numpy as np
import pyarrow as pa
import pytest

from fundtide.llm import decontamination, textops

from .conftest import SF


def rows_of(texts, index):
    """TF-IDF rows of all half passages, of length one."""
    hashes, doc = decontamination.word_hashes(*textops.utf8(pa.array(texts)))
    first, _ = decontamination.halves(doc)
    table = np.zeros((len(first), index.features.size))
    run = np.searchsorted(first, np.arange(len(hashes)), side="right") - 1
    feature = index.features(hashes)
    weight = index.idf[feature]
    weight /= np.sqrt(np.add.reduceat(weight**2, first))[run]
    np.add.at(table, (run, feature), weight)
    return table


def test_basis_of_all_documents(llm_spark, documents, corpus, monkeypatch):
    """It holds as much of all passages as the best one of its rank, nearly."""
    monkeypatch.setattr(decontamination, "FIT_DOCS", 10, raising=False)  # where a sample was fitted
    monkeypatch.setattr(decontamination, "RANK_MOST", 40)
    items = llm_spark.read.parquet(f"{SF}/benchmark.parquet").limit(3)
    index = decontamination.Index.build(documents.repartition(3), items)
    basis = index.rows / index.idf[:, None]
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-3)
    rows = rows_of(list(corpus.values()), index)
    best = np.sort(np.linalg.eigvalsh(rows @ rows.T))[::-1][:basis.shape[1] - 3].sum()
    assert ((rows @ basis) ** 2).sum() >= 0.95 * best


def test_products_with_the_transpose():
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, decontamination.HALF + 1, 300)
    first = np.cumsum(sizes) - sizes
    feature = (rng.zipf(1.3, sizes.sum()) % 50).astype(np.uint16)
    weight, y = rng.random(sizes.sum()).astype(np.float32), rng.normal(size=(300, 7)).astype(np.float32)
    out, want = np.zeros((50, 7), np.float32), np.zeros((50, 7))
    decontamination._add_transposed(feature, weight, first, y, out)
    np.add.at(want, feature, weight[:, None] * y[np.repeat(np.arange(300), sizes)])
    assert out == pytest.approx(want, rel=1e-4, abs=1e-4)
