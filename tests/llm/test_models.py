import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fundtide.llm import labelled, language, quality_model, quality_rules, textops, toxicity

from .conftest import ODD_TEXTS, SF


def crc_fold(doc_id, parts):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % parts


@pytest.fixture(scope="module")
def labels(llm_spark):
    return llm_spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def made(llm_spark):
    """Texts whose labels are known: rude words make a text toxic, shouting makes it poor."""
    rng = random.Random(1)
    plain = ["river", "stone", "window", "morning", "paper", "garden", "table", "winter", "silver", "walking"]
    rows, marks = [], []
    for k in range(600):
        words = rng.choices(plain, k=rng.randint(20, 200))
        toxic, poor = rng.random() < 0.2, rng.random() < 0.25
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["blockhead", "numbskull"]))
        text = ". ".join(" ".join(words[i:i + 9]) for i in range(0, len(words), 9)).replace(". ", ".\n") + "."
        if poor:
            text = "\n".join(line.upper().replace(" ", "!! ") + " ###" for line in text.split("\n"))
        rows.append((k, text))
        marks.append((k, int(not poor), int(toxic)))
    docs = llm_spark.createDataFrame(rows, "doc_id bigint, text string")
    return docs, llm_spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")


def accuracy(rows, truth, held_out=True):
    own = [r for r in rows if r["held_out"] == held_out]
    return sum(r["predicted"] == truth[r["doc_id"]] for r in own) / len(own)


def test_toxicity_on_held_out_texts(made):
    docs, labels = made
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert all(r["held_out"] == (crc_fold(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1 for r in rows)
    assert accuracy(rows, {r["doc_id"]: r["toxic"] for r in labels.collect()}) > 0.97


def test_labels_of_the_held_out_fold_change_nothing(made):
    from pyspark.sql import functions as F

    docs, labels = made
    other = labels.withColumn("toxic", F.when(labelled.fold("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.fit(docs, x) for x in (labels, other))
    assert np.array_equal(one.slot, two.slot) and np.allclose(one.weight, two.weight)


def test_quality_on_held_out_texts(made):
    docs, labels = made
    rows = quality_model.score(docs, quality_model.fit(docs, labels)).collect()
    assert accuracy(rows, {r["doc_id"]: r["quality"] for r in labels.collect()}) > 0.97
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_gradient_of_the_attention_model():
    rng = np.random.default_rng(2)
    x, doc = rng.normal(size=(9, quality_model.N_FEATURES)), np.array([0, 0, 0, 1, 1, 2, 3, 3, 3])
    y, weight = np.array([1.0, 0, 1, 0]), np.full(4, 0.25)
    model = quality_model.Model.parameters()
    model.read += rng.normal(size=model.read.shape)

    def loss():
        s = model.forward(x, doc, 4)["score"]
        return -(weight * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum()

    for field, gradient in zip(model.fields(), model.gradient(x, doc, y, weight), strict=True):
        for at in [tuple(rng.integers(0, s) for s in field.shape) for _ in range(4)]:
            field[at] += 1e-5
            up = loss()
            field[at] -= 2e-5
            down = loss()
            field[at] += 1e-5
            assert gradient[at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


@pytest.mark.parametrize("operator", [toxicity, quality_model])
def test_scores_of_odd_rows_and_missing_labels(odd, nothing, labels, documents, operator):
    model = operator.fit(documents, labels)
    rows = operator.score(odd, model).collect()
    assert len(rows) == len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert operator.score(nothing, model).count() == 0
    for some in (labels.limit(0), labels.filter("toxic = 0 AND quality = 1")):
        assert operator.score(odd, operator.fit(documents, some)).count() == len(ODD_TEXTS)


def test_language_on_held_out_texts(documents):
    truth = {r["doc_id"]: r["lang"] for r in documents.collect()}
    rows = language.identify(documents, language.fit(documents)).collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (crc_fold(r["doc_id"], 3) == 1) for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95


def test_a_mixture_has_its_languages(llm_spark, documents):
    model = language.fit(documents)
    by = {r["lang"]: r["text"] for r in documents.orderBy("n_chars").collect()}
    half = min(len(by["en"]), len(by["de"]))
    _, _, share = model.predict(pa.array([by["en"][:half] + "\n" + by["de"][:half]]))
    named = dict(zip(model.languages, share[0], strict=True))
    assert named["en"] == pytest.approx(0.5, abs=0.12) and named["de"] == pytest.approx(0.5, abs=0.12)
    assert share[0].sum() == pytest.approx(1)


def test_languages_of_odd_rows(odd, nothing, documents):
    from pyspark.sql import functions as F

    model = language.fit(documents)
    rows = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(odd, model).collect()}
    assert {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)} <= rows
    assert language.identify(nothing, model).count() == 0
    unknown = language.fit(documents.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language.identify(odd, unknown).collect()} == {"und"}


def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, twice = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            twice += line in seen
            seen.add(line)
    grams = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    count = Counter(grams)
    covered = {k + j for k, g in enumerate(grams) if count[g] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), twice, len(covered)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_base_figures(documents, corpus, odd, nothing):
    field = quality_rules.LineField.untrained()
    for r in quality_rules.assess(documents, field).collect():
        want = brute_base(corpus[r["doc_id"]])
        assert tuple(r[c] for c in BASE) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r["kept"] == (not r["base_failed"])
    got = Counter((r["doc_id"], *(r[c] for c in BASE)) for r in quality_rules.assess(odd, field).collect())
    assert got == Counter((d, *brute_base(t)) for d, t in ODD_TEXTS)
    assert quality_rules.keep_good(odd, field).columns == odd.columns
    assert quality_rules.assess(nothing, field).count() == 0


@pytest.mark.parametrize("text", ["a\r\na\r\n\n a\nb", "\n\n\n", "a\x0bb\x0cc d e f", "é É\né É\n", "x" * 5])
def test_base_figures_of_single_texts(text):
    found = quality_rules.measure(*textops.utf8(pa.array([text, text]))).base
    for k in range(2):
        assert tuple(int(found[c][k]) for c in BASE) == brute_base(text)


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(3)
    field = quality_rules.LineField(rng.normal(size=(3, 2)), rng.normal(size=(2, 2)))
    lengths = np.array([1, 6, 4, 6, 2])
    x = rng.normal(size=(lengths.sum(), 3))
    state, at = field.decode(x, lengths), 0
    for n in lengths:
        score = x[at:at + n] @ field.emission

        def value(path, score=score):
            return sum(score[i, s] for i, s in enumerate(path)) + sum(field.transition[a, b] for a, b in itertools.pairwise(path))

        assert tuple(state[at:at + n]) == max(itertools.product((0, 1), repeat=int(n)), key=value)
        at += n


def test_the_line_field_learns(made):
    docs, labels = made
    rows = quality_rules.assess(docs, quality_rules.fit_field(docs, labels)).collect()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    own = [r for r in rows if not r["base_failed"]]
    assert sum(r["kept"] == (truth[r["doc_id"]] == 1) for r in own) / len(own) > 0.97
    assert quality_rules.assess(docs, quality_rules.fit_field(docs, labels.limit(0))).filter("NOT base_failed AND NOT kept").count() == 0


def test_samples_are_bounded_and_do_not_depend_on_layout(made):
    docs, labels = made
    one = labelled.sample(docs, labels.unionByName(labels), "toxic", 30)
    assert {r["label"]: r["count"] for r in one.groupBy("label").count().collect()} == {0: 30, 1: 30}
    two = labelled.sample(docs.repartition(9), labels.repartition(5), "toxic", 30)
    assert {r["doc_id"] for r in one.collect()} == {r["doc_id"] for r in two.collect()}
