"""Best-fit packing of tokenised documents into sequences of a fixed length.

Only the histogram of piece lengths - at most ``capacity`` numbers, whatever the
corpus - comes to the driver.  There the configuration linear program (a variable
per way to fill a sequence, a constraint per length) is solved by multiplicative
weights, with an unbounded knapsack over lengths as the pricing step, and rounded
down; what is left goes best-fit, as many equal sequences at a time as there are
pieces for.  The plan is then a table of slots per length, and every piece finds
its slot from its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundtide.llm import textops, tokenizing
from fundtide.sources.workspace import materialized

CAPACITY = 2048
#: Pricing steps of the linear program, and how fast the weight of a covered length falls.
STEPS, RATE = 600, 3.0

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise every document, end it with ``end_id`` and cut what is longer than a sequence.

    The first piece of a cut document takes the remainder, the others are full.  A null text is
    empty and gives one piece with the end id; repeated rows each give their pieces.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizing.encoder(tokenizer_path).encode
        for batch in textops.chunks(batches, limit=tokenizing.CHUNK_BYTES, kind=tokenizing.KIND):
            ids, at = encode(*textops.utf8(batch.column("text")))
            ids = np.insert(ids, at[1:], np.uint32(end_id)).astype("<u4")
            ends = at[1:] + np.arange(1, len(at))
            sizes = np.diff(np.concatenate([[0], ends]))
            counts = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), counts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            head = (sizes - 1) % capacity + 1
            start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
            length = np.where(piece == 0, head[row], capacity)
            begin = (ends - sizes)[row] + start
            crc = [zlib.crc32(ids[b:e]) for b, e in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return textops.documents(docs, "doc_id", "text").mapInArrow(cut, PIECES)


@dataclass(frozen=True)
class Pattern:
    """``copies`` sequences that each hold ``items``: pairs of a length and how many of it."""

    copies: int
    items: tuple[tuple[int, int], ...]


def _knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> dict[int, int]:
    """The fill of one sequence with the highest price, each length as often as it fits."""
    best = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    usable = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(int(lengths[0]), capacity + 1):
        k = usable[room]
        values = best[room - lengths[:k]] + prices[:k]
        i = values.argmax()
        best[room], taken[room] = values[i], i
    fill: dict[int, int] = {}
    room = capacity
    while taken[room] >= 0:
        i = int(taken[room])
        fill[i] = fill.get(i, 0) + 1
        room -= int(lengths[i])
    return fill


def fractional(lengths: np.ndarray, demand: np.ndarray, capacity: int, steps: int = STEPS,
               rate: float = RATE) -> list[tuple[float, dict[int, int]]]:
    """Columns of the configuration program and their amounts, by multiplicative weights.

    A step prices every length by its size times exp(-rate * share covered so far), takes the
    best column, and adds as much of it as covers the scarcest of its lengths once.
    """
    covered = np.zeros(len(lengths))
    amounts: dict[tuple, float] = {}
    for _ in range(steps):
        prices = lengths * np.exp(-rate * np.minimum(covered / demand, 50.0))
        column = _knapsack(lengths, prices, capacity)
        keys = np.fromiter(column, int)
        times = np.fromiter(column.values(), int)
        amount = float((demand[keys] / times).min())
        covered[keys] += amount * times
        name = tuple(sorted(column.items()))
        amounts[name] = amounts.get(name, 0.0) + amount
    # What every length is covered by on average is the scale of the solution.
    total = float((lengths * demand).sum())
    scale = max(1.0, float((lengths * covered).sum()) / total)
    return [(amount / scale, dict(name)) for name, amount in amounts.items()]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> list[Pattern]:
    """Sequences that hold every piece of the histogram exactly once, as few as it can."""
    left = {int(k): int(v) for k, v in histogram.items() if v > 0}
    if any(k < 1 or k > capacity for k in left):
        raise ValueError("a piece does not fit into a sequence")
    patterns: list[Pattern] = []

    def use(items: dict[int, int], copies: int) -> None:
        for length, times in items.items():
            left[length] -= times * copies
            if left[length] == 0:
                del left[length]
        patterns.append(Pattern(copies, tuple(sorted(items.items(), reverse=True))))

    if left.get(capacity):
        use({capacity: 1}, left[capacity])
    if left:
        lengths = np.array(sorted(left))
        demand = np.array([left[k] for k in lengths.tolist()], float)
        columns = [(amount, {int(lengths[i]): n for i, n in column.items()})
                   for amount, column in fractional(lengths, demand, capacity, steps)]
        # Fullest columns first; a column that wastes room waits for the last step.
        columns.sort(key=lambda c: (-sum(k * n for k, n in c[1].items()), -c[0]))
        for amount, items in columns:
            copies = min(int(amount), *(left.get(k, 0) // n for k, n in items.items()))
            if copies > 0 and sum(k * n for k, n in items.items()) == capacity:
                use(items, copies)
    while left:  # best fit, longest first
        items: dict[int, int] = {}
        room = capacity
        for length in sorted(left, reverse=True):
            if (times := min(room // length, left[length])) > 0:
                items[length] = times
                room -= times * length
            if room == 0:
                break
        use(items, min(left[k] // n for k, n in items.items()))
    return patterns


def slots(patterns: list[Pattern]) -> np.ndarray:
    """Rows (length, first rank, pieces per sequence, first sequence, offset), by length and rank."""
    rows, used, sequence = [], {}, 0
    for pattern in patterns:
        offset = 0
        for length, times in pattern.items:
            first = used.get(length, 0)
            rows.append((length, first, times, sequence, offset))
            used[length] = first + times * pattern.copies
            offset += length * times
        sequence += pattern.copies
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranked(rows: DataFrame, parts: int) -> DataFrame:
    """Rank from 0 among the pieces of the same length.

    A length may hold a third of all pieces, so ranks count inside (length, part) and start
    where the earlier parts of the length end.
    """
    parted = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = parted.groupBy("length", "part").count().select(
        "length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    return (
        parted.withColumn("own", F.row_number().over(own) - 1).join(firsts, ["length", "part"])
        .withColumn("rank", F.col("first") + F.col("own")).drop("own", "first", "part")
    )


def pack(pieces_: DataFrame, capacity: int = CAPACITY, steps: int = STEPS) -> DataFrame:
    """Add sequence_id and offset to pieces; pieces of a sequence leave no gap from 0 on.

    An empty table gives an empty result.  Equal rows are placed apart.
    """
    spark = pieces_.sparkSession
    kept = materialized(pieces_, "pieces")
    histogram = {r["length"]: r["count"] for r in kept.groupBy("length").count().collect()}
    table = textops.shared(spark, slots(plan(histogram, capacity, steps)))
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = table.value
        stride = int(where[:, 1].max() + 1) if len(where) else 1
        keys = where[:, 0] * stride + where[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            # A rank beyond the last first rank belongs to the last slot row of its length.
            slot = where[np.searchsorted(keys, length * stride + np.minimum(rank, stride - 1), side="right") - 1]
            copy, turn = np.divmod(rank - slot[:, 1], slot[:, 2])
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(slot[:, 3] + copy), pa.array(slot[:, 4] + turn * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked(kept, parts).mapInArrow(place, PIECES + ", sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, tokenizer_path, end_id, capacity), capacity)
