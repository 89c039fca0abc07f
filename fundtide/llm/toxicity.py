"""Toxicity: a linear classifier over character n-grams scaled by log-count ratios.

Features are the presence of hashed n-grams of bytes (ASCII in lower case).  Each is
scaled by the naive Bayes log-count ratio of its class counts, the features of a text are
scaled to length 1, and a logistic model is fitted on those of a bounded labelled sample.
Scoring adds the weights of the n-grams that a whole text contains.

A model that has seen a text before is too sure of it, the more so the rarer its kind (a
language with few toxic texts).  So two more models are fitted, each on one half of the
sample, and the score is a logistic function of the sum, fitted on what each says about the
other half.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundtide.llm import labelled, textops
from fundtide.sources.workspace import materialized

#: Labelled documents per class that the model is fitted on.
SAMPLE = 8000
SIZES = (5, 7)
HASH_BITS = 22
#: N-grams that the model keeps: those that tell the classes apart best.  A small group's
#: n-grams need room beside those of the largest.
KEPT = 1 << 15
SMOOTHING, RIDGE, FOLDS, HELD_OUT = 1.0, 1e-4, 5, 0
#: Features whose counts travel together.
CHUNK = 1 << 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def ngrams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed n-grams that lie within one text, and the index of the text; one size at a time."""
    lower = _LOWER[data].astype(np.uint64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for n in SIZES:
        count = len(lower) - n + 1
        if count <= 0:
            continue
        packed = np.full(count, n, np.uint64)
        for k in range(n):
            packed = (packed << np.uint64(8)) | lower[k:k + count]
        inside = doc[:count] == doc[n - 1:]
        hashed = (packed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - HASH_BITS)
        yield hashed[inside].astype(np.int64), doc[:count][inside]


def present(data: np.ndarray, offsets: np.ndarray, slot: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (text, feature), each once; with ``slot`` only features that it maps to 0 or more."""
    pairs = []
    width = 1 << HASH_BITS if slot is None else int(slot.max()) + 1
    for hashed, doc in ngrams(data, offsets):
        if slot is not None:
            hashed = slot[hashed]
            doc, hashed = doc[hashed >= 0], hashed[hashed >= 0]
        pairs.append(doc * width + hashed)
    both = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    return both // width, both % width


@dataclass
class Model:
    slot: np.ndarray  # hash to feature, or -1
    weight: np.ndarray
    #: Log-count ratios, whose squares give a text's length.
    ratio: np.ndarray
    bias: float
    #: Slope and shift of the score.
    slope: float = 1.0
    shift: float = 0.0

    def sums(self, doc: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        """The linear part, from pairs of a text and a feature that it has."""
        square = self.ratio[feature]
        length = np.sqrt(np.bincount(doc, np.square(square, out=square), n))
        del square
        return self.bias + np.bincount(doc, self.weight[feature], n) / np.maximum(length, 1e-9)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        total = np.full(n, self.bias)
        if len(self.weight) and len(data):
            total = self.sums(*present(data, offsets, self.slot), n)
        return _sigmoid(self.slope * total + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _untold(prior: float) -> Model:
    return Model(np.full(1 << HASH_BITS, -1, np.int32), np.zeros(0), np.zeros(0), prior)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each half and label that have a feature: one row per chunk of features."""
    totals = np.zeros((4, 1 << HASH_BITS), np.uint32)
    for batch in textops.chunks(batches):
        group = 2 * batch.column("half").to_numpy(zero_copy_only=False) + batch.column("label").to_numpy(zero_copy_only=False)
        doc, feature = present(*textops.utf8(batch.column("text")))
        for k in range(4):
            own, times = np.unique(feature[group[doc] == k], return_counts=True)
            totals[k, own] += times.astype(np.uint32)
    pack = zstandard.ZstdCompressor(level=1).compress
    some = [(first // CHUNK, pack(part.tobytes())) for first in range(0, 1 << HASH_BITS, CHUNK)
            if (part := np.ascontiguousarray(totals[:, first:first + CHUNK])).any()]
    chunk, counts = zip(*some, strict=True) if some else ((), ())
    yield pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64()), pa.array(counts, pa.binary())], ["chunk", "counts"])


_CHOICE = "part int, feature bigint, ratio double, evidence double"


def _evidence(sizes: np.ndarray, kept: int):
    """Best features of a chunk, by a chi-square figure: for both halves (part 2) and for each alone."""
    def run(group: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        totals = np.zeros((4, CHUNK))
        for raw in group.column("counts").to_pylist():
            totals += np.frombuffer(unpack(raw), np.uint32).reshape(4, CHUNK)
        first = group.column("chunk")[0].as_py() * CHUNK
        found = []
        for part, halves in ((0, [0]), (1, [1]), (2, [0, 1])):
            clean, toxic = (sum(totals[2 * h + y] for h in halves) for y in (0, 1))
            n_clean, n_toxic = (sum(sizes[h, y] for h in halves) for y in (0, 1))
            if not n_clean or not n_toxic:
                continue
            p = (toxic + SMOOTHING) / (n_toxic + 2 * SMOOTHING)
            q = (clean + SMOOTHING) / (n_clean + 2 * SMOOTHING)
            value = (p - q)**2 / (p * (1 - p) / n_toxic + q * (1 - q) / n_clean)
            value[clean + toxic == 0] = 0
            best = np.argsort(-value, kind="stable")[:kept]
            best = best[value[best] > 0]
            found.append(pa.table({"part": pa.array(np.full(len(best), part), pa.int32()), "feature": best + first,
                                   "ratio": np.log(p / q)[best], "evidence": value[best]}))
        return pa.concat_tables(found)

    return run


def _fit_logistic(rows: np.ndarray, features: np.ndarray, value: np.ndarray, y: np.ndarray, weight: np.ndarray, size: int,
                  steps: int = 100, rate: float = 0.3) -> tuple[np.ndarray, float]:
    """Weights of ``size`` features by Adam; ``value`` has the entries of the matrix at (rows, features)."""
    theta, bias = np.zeros(size), 0.0
    mean, var = np.zeros(size + 1), np.zeros(size + 1)
    weight = weight / weight.sum()
    # One buffer of the matrix's size serves every step, instead of new ones for each product.
    entries = np.empty(len(value))
    for step in range(1, steps + 1):
        z = np.bincount(rows, np.multiply(np.take(theta, features, out=entries), value, out=entries), len(y)) + bias
        error = weight * (_sigmoid(z) - y)
        product = np.multiply(np.take(error, rows, out=entries), value, out=entries)
        gradient = np.append(np.bincount(features, product, size) + RIDGE * theta, error.sum())
        mean += 0.1 * (gradient - mean)
        var += 0.01 * (gradient**2 - var)
        move = rate * (mean / (1 - 0.9**step)) / (np.sqrt(var / (1 - 0.99**step)) + 1e-8)
        theta -= move[:-1]
        bias -= move[-1]
    return theta, float(bias)


def _calibrated(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic function of ``z`` that tells ``y`` best, by Newton steps.

    The targets stop short of 0 and 1, so that texts that are told apart without a fault have
    a finite slope.
    """
    toxic = weight[y == 1].sum()
    target = np.where(y == 1, (toxic + 1) / (toxic + 2), 1 / (weight.sum() - toxic + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(slope * z + shift)
        error, spread = weight * (p - target), weight * p * (1 - p)
        matrix = np.array([[(spread * z * z).sum(), (spread * z).sum()], [(spread * z).sum(), spread.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(matrix, [(error * z).sum(), error.sum()])
        step *= min(1.0, 2 / max(1e-9, np.abs(step).max()))
        slope, shift = slope - step[0], shift - step[1]
    return (float(slope), float(shift)) if slope > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE, kept: int = KEPT) -> Model:
    """Fit on at most ``per_class`` documents of each label outside the held-out fold.

    With labels of one class only, the score is that class's smoothed share; with none, one half.
    """
    allowed = labelled.fold("doc_id", FOLDS) != HELD_OUT
    chosen = labelled.sample(docs, labels.filter("toxic IN (0, 1)"), "toxic", per_class, allowed)
    known = labels.filter(allowed & F.col("toxic").isin(0, 1)).groupBy("toxic").count().collect()
    totals = np.zeros(2)
    for r in known:
        totals[r["toxic"]] = r["count"]
    prior = float(np.log((totals[1] + 1) / (totals[0] + 1)))
    if not totals.all():
        return _untold(prior)
    chosen = materialized(chosen.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int"))
                          .withColumn("label", F.col("label").cast("int")), "sample")
    sizes = np.zeros((2, 2))
    for r in chosen.groupBy("half", "label").count().collect():
        sizes[r["half"], r["label"]] = r["count"]
    if not sizes.sum(0).all():
        return _untold(prior)

    # Log-count ratios, and which features differ most.
    counts = chosen.mapInArrow(_counts, "chunk bigint, counts binary")
    evidence = counts.groupBy("chunk").applyInArrow(_evidence(sizes, kept), _CHOICE)
    best = Window.partitionBy("part").orderBy(F.desc("evidence"), "feature")
    choice = evidence.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= kept).select(
        "part", "feature", "ratio").toPandas()
    every = np.unique(choice["feature"].to_numpy())
    slot = np.full(1 << HASH_BITS, -1, np.int32)
    slot[every] = np.arange(len(every))

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.chunks(batches):
            doc, feature = present(*textops.utf8(batch.column("text")), slot)
            ends = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            own = [feature[a:b].astype("<i4").tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), batch.column("half"), pa.array(own, pa.binary())],
                ["doc_id", "label", "half", "features"])

    # The features reach the driver as one Arrow buffer, read in place: no row object or copy per text.
    table = chosen.mapInArrow(seen, "doc_id bigint, label int, half int, features binary").orderBy("doc_id").toArrow()
    y, half = (table.column(name).to_numpy().astype(np.int64) for name in ("label", "half"))
    features = table.column("features").combine_chunks()
    del table
    n = len(features)
    ends = np.frombuffer(features.buffers()[1], np.int32)[features.offset:features.offset + n + 1]
    doc = np.repeat(np.arange(n, dtype=np.int32), np.diff(ends) // 4)
    feature = (np.frombuffer(features.buffers()[2], "<i4", count=int(ends[-1] - ends[0]) // 4, offset=int(ends[0]))
               if ends[-1] > ends[0] else np.zeros(0, np.int32))
    weight = np.where(y == 1, totals[1] / sizes[:, 1].sum(), totals[0] / sizes[:, 0].sum())

    def learn(part: int, texts: np.ndarray, tell: bool = True) -> tuple[Model, np.ndarray | None]:
        """A model with the features of ``part``, fitted on ``texts``, and (if ``tell``) what it says about all."""
        mine = choice[choice["part"] == part].sort_values("feature")
        ratio = mine["ratio"].to_numpy()
        place = np.full(len(every), -1, np.int32)
        place[np.searchsorted(every, mine["feature"].to_numpy())] = np.arange(len(mine))
        has = place[feature] >= 0
        d, f = doc[has], place[feature[has]]
        length = np.maximum(np.sqrt(np.bincount(d, ratio[f]**2, n)), 1e-9)
        train = texts[d]
        d_train, f_train = (d, f) if train.all() else (d[train], f[train])
        value = ratio[f_train] / length[d_train]
        d_train = (np.cumsum(texts, dtype=np.int32) - 1)[d_train]
        del train, has, length
        theta, bias = _fit_logistic(d_train, f_train, value, y[texts], weight[texts], len(mine))
        del d_train, f_train, value
        hashes = np.full(1 << HASH_BITS, -1, np.int32)
        hashes[mine["feature"].to_numpy()] = np.arange(len(mine))
        model = Model(hashes, theta * ratio, ratio, bias)
        return model, model.sums(d, f, n) if tell else None

    model, _ = learn(2, np.ones(n, bool), tell=False)
    if sizes.all():
        said = np.zeros(n)
        for part in (0, 1):
            _, z = learn(part, half == part)
            said[half != part] = z[half != part]
        model.slope, model.shift = _calibrated(said, y, weight)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; null and empty texts get the score of no n-gram.

    A row without doc_id is in no fold.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.chunks(batches):
            value = shared.value.scores(*textops.utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(value), pa.array((value >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    rows = textops.documents(docs, "doc_id", "text").mapInArrow(run, "doc_id bigint, score double, predicted int")
    held = F.coalesce(labelled.fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), "score", "predicted")
