"""Vectorised helpers on Arrow batches of texts, used inside Spark tasks.

A batch of texts is one byte array and one offset array, so words, hashes and
windows of all its documents come from a few numpy passes.  ``chunks`` bounds the
bytes that are worked on at a time; one text is never cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64)

#: Space, tab, line feed, vertical tab, form feed, carriage return.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_powers = {"base": np.ones(1, np.uint64), "inverse": np.ones(1, np.uint64)}


def documents(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns only, by the types the operators expect; other columns cannot clash."""
    kinds = {"doc_id": "bigint", "text": "string"}
    return df.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in columns])


_handed_out: list = []


def shared(spark: SparkSession, value):
    """``value`` for all tasks, as a broadcast.  Callers state what bounds its size."""
    handle = spark.sparkContext.broadcast(value)
    _handed_out.append(handle)
    return handle


def take_back() -> None:
    """Free the executors of what earlier operators have shared.

    A frame that still needs a value gets it sent again, so this is safe at any time; it pays
    when the results of the earlier operators are written, as between the stages of a pipeline.
    """
    while _handed_out:
        _handed_out.pop().unpersist()


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the n + 1 offsets of its texts; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    at = at.astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0]:at[-1]], at - at[0]


#: What tasks leave in their worker for the next task of their kind, and how to free it.
_kept: dict[str, Callable[[], None]] = {}


def keep(kind: str, free: Callable[[], None]) -> None:
    """Something of use to later tasks of this kind stays in the worker until a task of another kind begins."""
    _kept[kind] = free


def _free_others(kind: str) -> None:
    for other in [k for k in _kept if k != kind]:
        _kept.pop(other)()
        _powers.update(base=np.ones(1, np.uint64), inverse=np.ones(1, np.uint64))
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES,
           kind: str = "") -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts have about ``limit`` bytes; at least one row each.

    A worker outlives its tasks: what tasks of another ``kind`` have left in it goes first, and
    what it holds free goes back to the system.
    """
    _free_others(kind)
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        factors = np.full(max(n, 1 << 16), _BASE if kind == "base" else _INVERSE, np.uint64)
        factors[0] = 1
        _powers[kind] = np.cumprod(factors, dtype=np.uint64)
    return _powers[kind][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Rolling:
    """64-bit hashes of any byte range of one buffer, from one prefix pass."""

    def __init__(self, data: np.ndarray):
        terms = _BYTE_VALUES[data]
        terms *= _power("base", len(data))
        self._prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, dtype=np.uint64, out=self._prefix[1:])
        self._n = len(data)

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of data[start:end] for each pair; equal bytes give equal hashes."""
        value = self._prefix[ends] - self._prefix[starts]
        value *= _power("inverse", self._n + 1)[starts]
        return mix(value + (ends - starts).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """Hash of data[i:i + width] for every i."""
        count = max(0, self._n - width + 1)
        value = self._prefix[width:width + count] - self._prefix[:count]
        value *= _power("inverse", self._n + 1)[:count]
        return mix(value + np.uint64(width))


def words(data: np.ndarray, offsets: np.ndarray, solid: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Start and end of every word and its document's index.

    A word is a run without the six ASCII spaces, or of the bytes that ``solid`` marks; it
    never spans two documents.
    """
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    if solid is None:
        solid = ~IS_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] = solid[first]
    stops = solid.copy()
    stops[:-1] &= ~solid[1:]
    last = first_ends(offsets) - 1
    stops[last] = solid[last]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def first_ends(offsets: np.ndarray) -> np.ndarray:
    """Ends of the documents that have bytes."""
    return offsets[1:][offsets[:-1] < offsets[1:]]


def grams(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``n`` consecutive words of one document, and that document's index."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = hashes[:count].copy()
    for k in range(1, n):
        value = mix(value * np.uint64(_BASE) + hashes[k:k + count])
    inside = doc[:count] == doc[n - 1:]
    return value[inside], doc[:count][inside]
