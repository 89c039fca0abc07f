"""Line sequence labelling: a linear-chain conditional random field marks content lines.

The base rules count words, symbols and repetition.  The field is fitted on the lines of
all labelled documents, each line taking its document's label, one Spark job per step; Viterbi
decoding then marks every line of a document as content or boilerplate, and the share of
words in content lines decides whether the document stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtide.llm import labelled, textops
from fundtide.sources.workspace import materialized

#: Weight of all boilerplate lines against all content lines in the fit: losing a good
#: document counts more than keeping a poor one.
BOILERPLATE_WEIGHT = 0.2
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
MIN_CONTENT_SHARE = 0.5
FEATURES = (
    "bias", "log_words", "upper_share", "symbol_share", "exclamations", "digit_share", "word_length",
    "seen_before", "repeated_share", "sentence_end",
)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER, _LETTER, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_UPPER[ord("A"):ord("Z") + 1] = True
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True
_LETTER[0xC0:0xF8] = True  # a character beyond ASCII counts as a letter
_DIGIT[ord("0"):ord("9") + 1] = True


def _sums(flags: np.ndarray) -> np.ndarray:
    """Prefix sums, so that sums over ranges are differences."""
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _seen(doc: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: does its key occur twice or more in its document, and did it occur earlier there?"""
    joint = textops.mix(keys ^ textops.mix(doc.astype(np.uint64)))
    order = np.argsort(joint, kind="stable")
    ranked = joint[order]
    same = ranked[1:] == ranked[:-1]
    earlier, repeated = np.zeros(len(joint), bool), np.zeros(len(joint), bool)
    earlier[order[1:]] = same
    repeated[order[1:]] |= same
    repeated[order[:-1]] |= same
    return repeated, earlier


@dataclass
class Measured:
    """Base figures per document, and features and words of the lines that have words."""

    base: dict[str, np.ndarray]
    lines: np.ndarray
    line_doc: np.ndarray
    line_words: np.ndarray


def measure(data: np.ndarray, offsets: np.ndarray) -> Measured:
    n = len(offsets) - 1
    starts, ends, doc = textops.words(data, offsets)
    solid = ~textops.IS_SPACE[data] & ((data & 0xC0) != 0x80)
    chars, symbols = _sums(solid), _sums(_SYMBOL[data])
    rolling = textops.Rolling(data)
    hashes = rolling.ranges(starts, ends)

    repeated = np.zeros(len(starts) + 1, np.int64)
    if len(starts) >= WINDOW:
        inside = np.flatnonzero(doc[:len(doc) - WINDOW + 1] == doc[WINDOW - 1:])
        keys, own = textops.grams(hashes, doc, WINDOW)
        twice = inside[_seen(own, keys)[0]]
        repeated[twice] += 1
        np.subtract.at(repeated, twice + WINDOW, 1)
    in_repeat = np.cumsum(repeated[:-1]) > 0

    breaks = np.flatnonzero(data == 0x0A)
    line_starts = np.union1d(offsets[:-1], breaks + 1)
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.append(line_starts[1:], len(data))
    has_break = (line_ends > 0) & (data[np.maximum(line_ends - 1, 0)] == 0x0A) if len(data) else line_ends > 0
    line_ends = line_ends - has_break
    word_first = np.searchsorted(starts, line_starts)
    n_words = np.searchsorted(starts, line_ends) - word_first
    keep = n_words > 0
    line_starts, line_ends, n_words, word_first = (x[keep] for x in (line_starts, line_ends, n_words, word_first))
    line_doc = np.searchsorted(offsets, line_starts, side="right") - 1
    _, earlier = _seen(line_doc, rolling.ranges(line_starts, line_ends))

    def within(prefix: np.ndarray) -> np.ndarray:
        return (prefix[line_ends] - prefix[line_starts]).astype(float)

    size = np.maximum(within(chars), 1)
    upper = _UPPER[data]
    if len(data) > 1:
        upper[:-1] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    letters = np.maximum(within(_sums(_LETTER[data])), 1)
    repeats = _sums(in_repeat)
    final = data[np.maximum(ends[word_first + n_words - 1] - 1, 0)] if len(n_words) else np.zeros(0, np.uint8)
    lines = np.column_stack([
        np.ones(len(line_starts)), np.log1p(n_words) / 5, within(_sums(upper)) / letters,
        np.minimum(1, 8 * within(symbols) / size), np.minimum(1, 8 * within(_sums(data == 0x21)) / size),
        within(_sums(_DIGIT[data])) / size, size / n_words / 10, earlier,
        (repeats[word_first + n_words] - repeats[word_first]) / np.maximum(n_words, 1),
        np.isin(final, list(b".?!")),
    ]).astype(float)
    count = lambda at, weights=None: np.bincount(at, weights, n).astype(np.int64)
    base = {
        "n_words": count(doc), "word_chars": chars[offsets[1:]] - chars[offsets[:-1]],
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]], "n_dup_lines": count(line_doc, earlier),
        "n_repeat_words": count(doc, in_repeat),
    }
    return Measured(base, lines, line_doc, n_words)


class LineField:
    """Two-state linear-chain conditional random field; state 1 is content."""

    def __init__(self, emission: np.ndarray, transition: np.ndarray):
        self.emission, self.transition = emission, transition

    @staticmethod
    def untrained() -> LineField:
        """Marks every line as content."""
        emission = np.zeros((len(FEATURES), 2))
        emission[0, 1] = 1.0
        return LineField(emission, np.zeros((2, 2)))

    @staticmethod
    def _layout(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First line of each sequence, longest sequence first, and how many last beyond step t."""
        order = np.argsort(-lengths, kind="stable")
        first = (np.cumsum(lengths) - lengths)[order]
        longest = int(lengths.max()) if len(lengths) else 0
        active = np.searchsorted(-lengths[order], -np.arange(longest), side="left")
        return first, active

    @classmethod
    def fit(cls, x: np.ndarray, lengths: np.ndarray, y: np.ndarray, weight: np.ndarray,
            steps: int = 250, rate: float = 0.2, ridge: float = 1e-4) -> LineField:
        """Maximum likelihood by Adam on exact forward-backward gradients; ``weight`` per sequence."""
        total = np.repeat(weight, lengths).sum()
        return cls.adam(lambda theta: _differences(x, lengths, y, weight, theta), total, steps, rate, ridge)

    @classmethod
    def adam(cls, differences, total: float, steps: int = 250, rate: float = 0.2, ridge: float = 1e-4) -> LineField:
        """Adam from zero; ``differences(theta)`` gives the weighted gold minus expected sums of all sequences."""
        theta = [np.zeros((len(FEATURES), 2)), np.zeros((2, 2))]
        mean, var = [np.zeros_like(p) for p in theta], [np.zeros_like(p) for p in theta]
        for step in range(1, steps + 1):
            grads = [d / total - ridge * p for d, p in zip(differences(theta), theta, strict=True)]
            for p, g, m, v in zip(theta, grads, mean, var, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return cls(*theta)

    def decode(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The best state of every line; sequences stand in a row, ``lengths`` lines each."""
        state = np.zeros(len(x), np.int8)
        if len(x) == 0:
            return state
        first, active = self._layout(lengths)
        best = x @ self.emission
        came = np.zeros((len(x), 2), np.int8)
        for t in range(1, len(active)):
            at = first[:active[t]] + t
            joint = best[at - 1][:, :, None] + self.transition
            came[at] = joint.argmax(axis=1)
            best[at] += joint.max(axis=1)
        for t in range(len(active) - 1, -1, -1):
            at = first[:active[t]] + t
            ending = active[t + 1] if t + 1 < len(active) else 0
            state[at[ending:]] = best[at[ending:]].argmax(axis=1)
            if ending:
                later = at[:ending] + 1
                state[at[:ending]] = came[later, state[later]]
        return state


def _differences(x: np.ndarray, lengths: np.ndarray, y: np.ndarray, weight: np.ndarray,
                 theta: list[np.ndarray]) -> list[np.ndarray]:
    """Gold minus expected feature and transition sums of sequences in a row, ``weight`` per sequence."""
    first, active = LineField._layout(lengths)
    order = np.argsort(-lengths, kind="stable")
    w = weight[order]
    line_weight = np.repeat(weight, lengths)
    gold = np.zeros((len(x), 2))
    gold[np.arange(len(x)), y] = 1.0
    pair_gold = np.zeros((2, 2))
    for t in range(1, len(active)):
        at = first[:active[t]] + t
        np.add.at(pair_gold, (y[at - 1], y[at]), w[:active[t]])
    score = x @ theta[0]
    alpha, beta = np.zeros_like(score), np.zeros_like(score)
    for t in range(len(active)):
        at = first[:active[t]] + t
        alpha[at] = score[at]
        if t:
            joint = alpha[at - 1][:, :, None] + theta[1]
            alpha[at] += np.logaddexp(joint[:, 0], joint[:, 1])
    pair = np.zeros((2, 2))
    for t in range(len(active) - 1, 0, -1):
        at = first[:active[t]] + t
        onward = score[at] + beta[at]
        joint = theta[1] + onward[:, None, :]
        beta[at - 1] = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
        both = alpha[at - 1][:, :, None] + joint
        both -= both.max(axis=(1, 2), keepdims=True)
        share = np.exp(both)
        share /= share.sum(axis=(1, 2), keepdims=True)
        pair += np.einsum("nij,n->ij", share, w[:active[t]])
    post = alpha + beta
    post = np.exp(post - np.logaddexp(post[:, 0], post[:, 1])[:, None])
    return [x.T @ ((gold - post) * line_weight[:, None]), pair_gold - pair]


def _training_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in textops.chunks(batches):
        found = measure(*textops.utf8(batch.column("text")))
        first = np.searchsorted(found.line_doc, np.arange(batch.num_rows))
        stop = np.searchsorted(found.line_doc, np.arange(batch.num_rows), side="right")
        rows = [found.lines[a:b].astype("<f8").tobytes() for a, b in zip(first, stop, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("label").cast(pa.int64()), pa.array(rows, pa.binary())], ["label", "lines"])


def _read_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Features, line counts and labels of the documents of some batches that have lines."""
    for batch in batches:
        found = [(y, np.frombuffer(x, "<f8").reshape(-1, len(FEATURES)))
                 for y, x in zip(batch.column("label").to_pylist(), batch.column("lines").to_pylist())]
        found = [(y, x) for y, x in found if len(x)]
        if found:
            yield (np.concatenate([x for _, x in found]), np.array([len(x) for _, x in found]),
                   np.array([y for y, _ in found], np.int64))


def fit_field(docs: DataFrame, labels: DataFrame) -> LineField:
    """Fit on every document with a quality label of 0 or 1, each Adam step one Spark job over all of them.

    Without documents of both labels there is nothing to tell apart, and every line is content.
    """
    chosen = labelled.every(docs, labels, "quality").filter(F.col("label").isin(0, 1))
    lines = materialized(chosen.mapInArrow(_training_lines, "label bigint, lines binary"), "field_lines")

    def count_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs_lines = np.zeros((2, 2), np.int64)
        for x, lengths, y in _read_lines(batches):
            docs_lines += np.stack([np.bincount(y, minlength=2), np.bincount(y, lengths, 2).astype(np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(docs_lines.ravel())], ["n"])

    counted = np.array([r["n"] for r in lines.mapInArrow(count_lines, "n bigint").collect()]).reshape(-1, 2, 2).sum(0)
    if not counted[0].all():
        return LineField.untrained()
    weights = counted[1].sum() / counted[1] * np.array([BOILERPLATE_WEIGHT, 1.0])

    def differences(theta: list[np.ndarray]) -> list[np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = [np.zeros_like(p) for p in theta]
            for x, lengths, y in _read_lines(batches):
                for s, d in zip(sums, _differences(x, lengths, np.repeat(y, lengths), weights[y], theta), strict=True):
                    s += d
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([s.ravel() for s in sums]).tobytes()])], ["sums"])

        total = sum(np.frombuffer(r["sums"], "<f8") for r in lines.mapInArrow(run, "sums binary").collect())
        size = theta[0].size
        return [total[:size].reshape(theta[0].shape), total[size:].reshape(theta[1].shape)]

    return LineField.adam(differences, float(counted[1] @ weights))


RESULT = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, base_failed boolean, kept boolean, content_share double, n_lines bigint, "
          "n_content_lines bigint")


def judge(data: np.ndarray, offsets: np.ndarray, field: LineField) -> dict[str, np.ndarray]:
    """Figures and verdict of each text."""
    n = len(offsets) - 1
    found = measure(data, offsets)
    lengths = np.bincount(found.line_doc, minlength=n)
    content = field.decode(found.lines, lengths[lengths > 0]) == 1
    words = found.base["n_words"]
    share = np.bincount(found.line_doc, found.line_words * content, n) / np.maximum(words, 1)
    failed = (words < MIN_WORDS) | (100 * found.base["n_repeat_words"] > MAX_REPEAT_PERCENT * words)
    return found.base | {
        "base_failed": failed, "kept": ~failed & (share >= MIN_CONTENT_SHARE), "content_share": share,
        "n_lines": lengths, "n_content_lines": np.bincount(found.line_doc, content, n).astype(np.int64),
    }


def assess(docs: DataFrame, field: LineField) -> DataFrame:
    """One row per row of ``docs``, repeated ones included; a verdict depends on the text alone.

    Null and empty texts have no word, so the base rules reject them.  Of equally good
    labellings of the lines, Viterbi takes boilerplate.
    """
    shared = textops.shared(docs.sparkSession, field)
    names = [item.split()[0] for item in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.chunks(batches):
            verdict = judge(*textops.utf8(batch.column("text")), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(verdict[name]) for name in names[1:]]], names)

    return textops.documents(docs, "doc_id", "text").mapInArrow(run, RESULT)


def keep_good(docs: DataFrame, field: LineField) -> DataFrame:
    """The rows of ``docs``, all columns, whose text passes."""
    shared = textops.shared(docs.sparkSession, field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.chunks(batches):
            verdict = judge(*textops.utf8(batch.column("text")), shared.value)
            yield batch.filter(pa.array(verdict["kept"]))

    return docs.mapInArrow(run, docs.schema)
