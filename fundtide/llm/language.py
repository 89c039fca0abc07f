"""Language identification by mixtures: which languages a text consists of, and in what shares.

Every language has a distribution over hashed letter trigrams.  For each text
expectation-maximisation estimates the languages' proportions from its trigram counts;
the set of languages grows, best first, as long as the penalised likelihood does.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtide.llm import labelled, textops

#: Documents per language that the trigram counts come from.
SAMPLE = 3000
HASH_BITS = 13
SMOOTHING = 0.5
FOLDS, HELD_OUT = 3, 1
ROUNDS, DOCS_AT_A_TIME = 15, 128
UNKNOWN = "und"


def _letters_table() -> np.ndarray:
    """Code point to letter in lower case or 0, for the basic plane; cases of one letter only."""
    table = np.zeros(1 << 16, np.uint32)
    for c in range(1 << 16):
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else c
    return table


_LETTERS = _letters_table()


def letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts, 0 for anything else, and offsets; a 0 stands at each end."""
    filled = ["" if t is None else t for t in texts.to_pylist()]
    joined = "\0".join(filled) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    beyond = points >= 1 << 16
    low = _LETTERS[np.where(beyond, 0, points)]
    if beyond.any():  # letters of the other planes keep their case
        at = np.flatnonzero(beyond)
        low[at] = [p if chr(p).isalpha() else 0 for p in points[at].tolist()]
    lengths = np.array([len(t) + 1 for t in filled], np.int64)
    return low, np.concatenate([[0], np.cumsum(lengths)])


def counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Trigram counts (texts x 2^HASH_BITS) and letters per text.  Runs of other characters are one gap."""
    low, offsets = letters(texts)
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    solid = low > 0
    n_letters = np.bincount(doc, solid, n).astype(np.int64)
    keep = solid.copy()
    keep[1:] |= solid[:-1]  # one gap after each word
    low, doc = low[keep].astype(np.uint64), doc[keep]
    low = np.concatenate([[0], low]).astype(np.uint64)
    doc = np.concatenate([doc[:1], doc])
    if len(low) < 3:
        return np.zeros((n, 1 << HASH_BITS)), n_letters
    packed = (low[:-2] << np.uint64(42)) | (low[1:-1] << np.uint64(21)) | low[2:]
    hashed = ((packed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
    owner = doc[2:]
    middle = low[1:-1] > 0
    size = 1 << HASH_BITS
    table = np.bincount(owner[middle] * size + hashed[middle], minlength=n * size)
    return table.reshape(n, size).astype(float), n_letters


@dataclass
class Model:
    languages: list[str]
    probability: np.ndarray  # languages x trigrams

    def mixture(self, table: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions of the allowed languages of each text, and the log-likelihood."""
        share = allowed / allowed.sum(axis=1, keepdims=True)
        total = np.maximum(table.sum(axis=1, keepdims=True), 1)
        for _ in range(ROUNDS):
            share = share * ((table / (share @ self.probability)) @ self.probability.T) / total
            share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
        return share, (table * np.log(share @ self.probability)).sum(axis=1)

    def proportions(self, table: np.ndarray) -> np.ndarray:
        """Shares of the languages of the best set; a language more costs half the log of the trigrams."""
        n, k = len(table), len(self.languages)
        penalty = 0.5 * np.log(np.maximum(table.sum(axis=1), 2))
        alone = table @ np.log(self.probability).T
        best = np.eye(k)[alone.argmax(axis=1)]
        value = alone.max(axis=1)
        if k == 1:
            return best
        order = np.argsort(-self.mixture(table, np.ones((n, k)))[0], axis=1, kind="stable")
        growing = np.arange(n)
        for size in range(2, k + 1):
            allowed = np.zeros((len(growing), k))
            np.put_along_axis(allowed, order[growing, :size], 1.0, axis=1)
            share, likelihood = self.mixture(table[growing], allowed)
            gain = likelihood - penalty[growing] * (size - 1) > value[growing]
            growing, share, likelihood = growing[gain], share[gain], likelihood[gain]
            best[growing] = share
            value[growing] = likelihood - penalty[growing] * (size - 1)
            if len(growing) == 0:
                break
        return best

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Leading language, its share, and the shares of all languages of each text."""
        table, n_letters = counts(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros((len(texts), 0))
        share = self.proportions(table)
        first = share.argmax(axis=1)
        names = [self.languages[i] if m else UNKNOWN for i, m in zip(first.tolist(), n_letters.tolist(), strict=True)]
        share[n_letters == 0] = 0.0
        return names, np.clip(share.max(axis=1), 0, 1), share


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At most DOCS_AT_A_TIME texts at a time, as each has a full row of counts."""
    for batch in textops.chunks(batches):
        for at in range(0, batch.num_rows, DOCS_AT_A_TIME):
            yield batch.slice(at, DOCS_AT_A_TIME)


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in _small(batches):
        table, _ = counts(batch.column("text"))
        names = np.array(batch.column("label").to_pylist())
        for name in set(names.tolist()):
            totals[name] = totals.get(name, 0) + table[names == name].sum(axis=0)
    for name, total in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(total)), pa.array(np.arange(len(total))), pa.array(total.astype(np.int64))],
            ["language", "trigram", "n"])


def fit(docs: DataFrame, per_language: int = SAMPLE) -> Model:
    """Trigram distributions from at most ``per_language`` documents of each language outside the held-out fold.

    Rows without text or language teach nothing; without any, every prediction is ``und``.
    """
    rows = docs.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in (
        ("doc_id", "bigint"), ("text", "string"), ("lang", "string"))])
    rows = rows.filter(F.col("text").isNotNull())
    allowed = labelled.fold("doc_id", FOLDS) != HELD_OUT
    chosen = labelled.sample(rows, rows, "lang", per_language, allowed)
    totals = chosen.mapInArrow(_trigrams, "language string, trigram bigint, n bigint").groupBy("language", "trigram").agg(
        F.sum("n").alias("n"))
    found = totals.filter("n > 0").collect()  # languages x trigrams at most
    languages = sorted({r["language"] for r in found})
    table = np.full((len(languages), 1 << HASH_BITS), SMOOTHING)
    place = {name: i for i, name in enumerate(languages)}
    for r in found:
        table[place[r["language"]], r["trigram"]] += r["n"]
    return Model(languages, table / table.sum(axis=1, keepdims=True))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score and n_languages of the chosen set for every row.

    Null texts and texts without a letter are ``und`` with score 0 and no language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            names, value, share = shared.value.predict(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(value),
                 pa.array((share > 0).sum(axis=1).astype(np.int64))],
                ["doc_id", "lang_pred", "score", "n_languages"])

    rows = textops.documents(docs, "doc_id", "text").mapInArrow(
        run, "doc_id bigint, lang_pred string, score double, n_languages bigint")
    held = F.coalesce(labelled.fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), "lang_pred", "score", "n_languages")
