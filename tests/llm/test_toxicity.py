"""Toxicity against a plain version, and what it finds in texts that it has not seen."""

import math
import os

import numpy as np
import pytest

from fundtide.llm import toxicity

BIG = "/root/testdata/sf0.1"


def plain_features(text, slot):
    """Numbers of the kept n-grams of a text, one slice at a time."""
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    found = set()
    for n in toxicity.SIZES:
        for i in range(len(raw) - n + 1):
            packed = int.from_bytes(bytes([n]) + raw[i:i + n], "big")
            hashed = (packed * 0x9E3779B97F4A7C15 % 2**64) >> (64 - toxicity.HASH_BITS)
            if slot[hashed] >= 0:
                found.add(int(slot[hashed]))
    return found


def test_scores_equal_a_plain_version(llm_spark, documents):
    labels = llm_spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = toxicity.fit(documents, labels, kept=500)
    rows = {r["doc_id"]: r for r in toxicity.score(documents, model).collect()}
    for doc_id, text in [(r["doc_id"], r["text"]) for r in documents.limit(60).collect()]:
        features = plain_features(text, model.slot)
        length = math.sqrt(sum(model.ratio[f]**2 for f in features))
        z = model.bias + sum(model.weight[f] for f in features) / max(length, 1e-9)
        assert rows[doc_id]["score"] == pytest.approx(1 / (1 + math.exp(-(model.slope * z + model.shift))), rel=1e-9)
        assert rows[doc_id]["predicted"] == (rows[doc_id]["score"] >= 0.5)


def test_gradient_steps_reach_the_optimum():
    """The loss of the fitted weights is not lower anywhere near them."""
    rng = np.random.default_rng(4)
    x = (rng.random((80, 6)) < 0.4) * rng.normal(1, 0.2, (80, 6))
    y = (x @ rng.normal(0, 2, 6) + rng.normal(0, 0.5, 80) > 0).astype(float)
    weight = np.ones(80)
    rows, features = np.nonzero(x)
    theta, bias = toxicity._fit_logistic(rows, features, x[rows, features], y, weight, 6, steps=4000, rate=0.02)

    def loss(t, b):
        p = np.clip(toxicity._sigmoid(x @ t + b), 1e-12, 1 - 1e-12)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean() + toxicity.RIDGE / 2 * (t**2).sum()

    best = loss(theta, bias)
    for _ in range(200):
        assert loss(theta + rng.normal(0, 0.05, 6), bias + rng.normal(0, 0.05)) >= best - 1e-6


def test_calibration_moves_the_threshold():
    rng = np.random.default_rng(5)
    y = (rng.random(4000) < 0.1).astype(int)
    z = rng.normal(0, 1, 4000) + 3 * y - 6  # told apart, but always below 0
    slope, shift = toxicity._calibrated(z, y, np.ones(4000))
    said = slope * z + shift > 0
    assert slope > 0 and (said == y).mean() > 0.95 and said[y == 1].mean() > 0.7
    assert toxicity._calibrated(-z, y, np.ones(4000)) == (1.0, 0.0)


@pytest.mark.skipif(not os.path.isdir(BIG), reason="the larger tables are not here")
def test_held_out_texts_of_all_languages(llm_spark):
    docs, labels = (llm_spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).filter("held_out")
    rows = scored.join(labels.select("doc_id", "toxic"), "doc_id").join(docs.select("doc_id", "lang"), "doc_id").filter(
        "toxic IS NOT NULL").collect()

    def recall(some):
        return sum(r["predicted"] for r in some) / len(some)

    toxic = [r for r in rows if r["toxic"] == 1]
    assert recall(toxic) >= 0.85
    assert all(recall([r for r in toxic if r["lang"] == lang]) >= 0.7 for lang in ("de", "fr"))
    assert len([r for r in toxic if r["predicted"]]) / sum(r["predicted"] for r in rows) >= 0.95
