"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages (runs of words).  Each passage becomes a small vector
of surface figures, an encoder layer embeds it, gated attention weighs the passages,
and the weighted embedding is scored.  Only whole documents have labels, so the
attention learns from them which passages matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtide.llm import labelled, textops

#: Labelled documents per class that the model is fitted on, with all their passages.
SAMPLE = 2000
PASSAGE_WORDS = 64
HIDDEN, GATE = 16, 8
FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.7
_REPEAT = 5

_GROUPS = {
    "upper": [(0x41, 0x5A)], "lower": [(0x61, 0x7A)], "digit": [(0x30, 0x39)], "beyond": [(0xC0, 0xF7)],
    "stop": [(0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F)], "comma": [(0x2C, 0x2C), (0x3A, 0x3B)],
    "shout": [(0x21, 0x21)], "mark": [(0x23, 0x26), (0x2A, 0x2A), (0x3C, 0x3C), (0x3E, 0x3E)], "bar": [(0x7C, 0x7C)],
    "newline": [(0x0A, 0x0A)], "quote": [(0x22, 0x22), (0x27, 0x29)], "slash": [(0x2F, 0x2F), (0x40, 0x40), (0x5C, 0x5F)],
}
_FLAGS = np.zeros((len(_GROUPS), 256), bool)
for _i, _ranges in enumerate(_GROUPS.values()):
    for _a, _b in _ranges:
        _FLAGS[_i, _a:_b + 1] = True
N_FEATURES = len(_GROUPS) + 6


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage and the index of its text; a text without words has one empty passage."""
    n = len(offsets) - 1
    starts, ends, doc = textops.words(data, offsets)
    place = np.arange(len(doc)) - np.searchsorted(doc, doc)
    first = np.flatnonzero(place % PASSAGE_WORDS == 0)
    owner = doc[first]
    stop = np.append(first[1:], len(doc))
    count = stop - first
    begin, end = starts[first] if len(first) else first, ends[stop - 1] if len(first) else first
    size = np.maximum(end - begin, 1).astype(float)
    columns = []
    for flags in _FLAGS:
        sums = np.concatenate([[0], np.cumsum(flags[data])])
        columns.append(np.minimum(1, 4 * (sums[end] - sums[begin]) / size))
    hashes = textops.Rolling(data).ranges(starts, ends)

    def shares(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return (sums[stop] - sums[first]) / np.maximum(count, 1)

    joint = textops.mix(hashes ^ textops.mix(doc.astype(np.uint64)))
    again = np.ones(len(joint), bool)
    again[np.unique(joint, return_index=True)[1]] = False
    covered = np.zeros(len(doc) + 1, np.int64)
    if len(doc) >= _REPEAT:
        inside = np.flatnonzero(doc[:len(doc) - _REPEAT + 1] == doc[_REPEAT - 1:])
        keys, own = textops.grams(hashes, doc, _REPEAT)
        _, inverse, times = np.unique(textops.mix(keys ^ textops.mix(own.astype(np.uint64))),
                                      return_inverse=True, return_counts=True)
        twice = inside[times[inverse] > 1]
        covered[twice] += 1
        np.subtract.at(covered, twice + _REPEAT, 1)
    letters = np.maximum(columns[0] + columns[1], 1e-9)
    columns += [np.minimum(count, PASSAGE_WORDS) / PASSAGE_WORDS, size / np.maximum(count, 1) / 10, shares(again),
                shares(np.cumsum(covered[:-1]) > 0), columns[0] / letters, np.log1p(place[first]) / 10]
    features = np.column_stack(columns) if len(first) else np.zeros((0, N_FEATURES))
    bare = np.setdiff1d(np.arange(n), owner)
    if len(bare):
        features = np.concatenate([features, np.zeros((len(bare), N_FEATURES))])
        owner = np.concatenate([owner, bare])
        order = np.argsort(owner, kind="stable")
        features, owner = features[order], owner[order]
    return features, owner


@dataclass
class Model:
    encode: np.ndarray
    encode_bias: np.ndarray
    attend: np.ndarray
    gate: np.ndarray
    choose: np.ndarray
    read: np.ndarray
    read_bias: np.ndarray

    @staticmethod
    def parameters(seed: int = 7) -> Model:
        r = np.random.default_rng(seed)
        draw = lambda *s: r.normal(0, 1 / np.sqrt(s[0]), s)
        return Model(draw(N_FEATURES, HIDDEN), np.zeros(HIDDEN), draw(HIDDEN, GATE), draw(HIDDEN, GATE), draw(GATE),
                     np.zeros(HIDDEN), np.zeros(1))

    def forward(self, x: np.ndarray, doc: np.ndarray, n: int) -> dict[str, np.ndarray]:
        """All layers; ``doc`` is ascending and every text has a passage."""
        first = np.searchsorted(doc, np.arange(n))
        h = np.tanh(x @ self.encode + self.encode_bias)
        t, g = np.tanh(h @ self.attend), 1 / (1 + np.exp(-(h @ self.gate)))
        a = (t * g) @ self.choose
        a = np.exp(a - np.maximum.reduceat(a, first)[doc])
        a /= np.add.reduceat(a, first)[doc]
        bag = np.add.reduceat(a[:, None] * h, first)
        z = bag @ self.read + self.read_bias[0]
        return {"h": h, "t": t, "g": g, "a": a, "bag": bag, "score": 1 / (1 + np.exp(-np.clip(z, -50, 50)))}

    def gradient(self, x: np.ndarray, doc: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Of the weighted log loss, by the order of the fields."""
        f = self.forward(x, doc, len(y))
        dz = weight * (f["score"] - y)
        dbag = dz[:, None] * self.read
        h, t, g, a = f["h"], f["t"], f["g"], f["a"]
        dh = a[:, None] * dbag[doc]
        da = (dbag[doc] * h).sum(axis=1)
        first = np.searchsorted(doc, np.arange(len(y)))
        ds = a * (da - np.add.reduceat(a * da, first)[doc])
        dt, dg = ds[:, None] * self.choose * g, ds[:, None] * self.choose * t
        dt *= 1 - t * t
        dg *= g * (1 - g)
        dh += dt @ self.attend.T + dg @ self.gate.T
        dpre = dh * (1 - h * h)
        return [x.T @ dpre, dpre.sum(axis=0), h.T @ dt, h.T @ dg, (ds[:, None] * t * g).sum(axis=0),
                f["bag"].T @ dz, np.array([dz.sum()])]

    def fields(self) -> list[np.ndarray]:
        return [self.encode, self.encode_bias, self.attend, self.gate, self.choose, self.read, self.read_bias]


def train(x: np.ndarray, doc: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 250, rate: float = 0.02,
          ridge: float = 1e-4) -> Model:
    """Adam on the whole sample, which is bounded."""
    model = Model.parameters()
    weight = weight / weight.sum()
    fields = model.fields()
    mean, var = [np.zeros_like(p) for p in fields], [np.zeros_like(p) for p in fields]
    for step in range(1, steps + 1):
        for p, g, m, v in zip(fields, model.gradient(x, doc, y, weight), mean, var, strict=True):
            g = g + ridge * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in textops.chunks(batches):
        x, doc = passages(*textops.utf8(batch.column("text")))
        ends = np.searchsorted(doc, np.arange(batch.num_rows + 1))
        rows = [x[a:b].astype("<f4").tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label").cast(pa.int64()), pa.array(rows, pa.binary())],
            ["doc_id", "label", "passages"])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> Model | float:
    """Fit on at most ``per_class`` documents of each label outside the held-out fold.

    Without both classes there is nothing to learn; the result is then the smoothed share of good ones.
    """
    allowed = labelled.fold("doc_id", FOLDS) != HELD_OUT
    known = labels.filter(allowed & F.col("quality").isin(0, 1))
    totals = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    chosen = labelled.sample(docs, known, "quality", per_class)
    rows = chosen.mapInArrow(_training, "doc_id bigint, label bigint, passages binary").orderBy("doc_id").collect()
    y = np.array([r["label"] for r in rows], float)
    if len(set(y.tolist())) < 2:
        return (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
    parts = [np.frombuffer(r["passages"], "<f4").reshape(-1, N_FEATURES).astype(float) for r in rows]
    weight = np.where(y == 1, totals[1] / (y == 1).sum(), totals[0] / (y == 0).sum())
    return train(np.concatenate(parts), np.repeat(np.arange(len(parts)), list(map(len, parts))), y, weight)


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """doc_id, held_out, score, predicted and the number of passages for every row.

    A null or empty text is one empty passage.  A row without doc_id is in no fold.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.chunks(batches):
            x, doc = passages(*textops.utf8(batch.column("text")))
            n = batch.num_rows
            own = shared.value
            value = np.full(n, own) if isinstance(own, float) else own.forward(x, doc, n)["score"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(value), pa.array((value >= THRESHOLD).astype(np.int32)),
                 pa.array(np.bincount(doc, minlength=n).astype(np.int64))],
                ["doc_id", "score", "predicted", "n_passages"])

    rows = textops.documents(docs, "doc_id", "text").mapInArrow(
        run, "doc_id bigint, score double, predicted int, n_passages bigint")
    held = F.coalesce(labelled.fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), "score", "predicted", "n_passages")
