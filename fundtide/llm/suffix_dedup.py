"""Exact removal of byte strings of a given length that occur more than once.

A sorted list of all suffixes would need several times the corpus; a sampled one is
enough.  Every window of ``width`` bytes chooses the smallest hash among its grams of
``gram`` bytes, a choice that depends on the window alone, so equal windows choose the
same place.  Neighbouring windows with one choice form a *segment*, and the suffix at
the chosen place stands for all of them: about one suffix per 40 bytes.

1. The suffixes are range-partitioned by their leading tokens (hash of the gram, hash of
   the segment's bytes, then row and position) with sampled splitters, so a token that
   is frequent spreads over many buckets.  Each bucket sorts with multikey quicksort and
   compares neighbours; groups that reach a bucket's edge are compared across edges.
   Equal segments repeat as a whole.
2. Segments that share their gram with a *different* segment may repeat in part.  One of
   each such segment goes through the same sort again, now with a suffix for each of its
   windows.
3. Each document cuts out the union of its repeated windows.

Hashes have 64 bits and count together with the gram's, so 128 bits decide equality.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundtide.llm import textops
from fundtide.sources.workspace import materialized

WIDTH, GRAM = 200, 120
#: Suffixes whose order the splitters come from, and suffixes that a bucket should hold.
SPLITTER_SAMPLE, BUCKET_ROWS = 40_000, 1_500_000
#: Windows of one text, bytes of text and suffixes that a task holds at a time.
SLICE, CHUNK_BYTES, SEND_ROWS = 1 << 18, 1 << 18, 200_000
#: Below this many rows a stretch is sorted at once.
LEAF = 4096

_SUFFIX = np.dtype([("t0", "<u8"), ("t1", "<u8"), ("key", "<i8"), ("at", "<i8"), ("n", "<i4")])
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by running minima of blocks from both ends."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def segments(data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> np.ndarray:
    """The sampled suffixes of a batch of texts, one per segment."""
    if len(data) > SLICE + width and len(offsets) == 2:
        parts = []
        for at in range(0, len(data) - width + 1, SLICE):
            piece = data[at:at + SLICE + width - 1]
            part = segments(piece, np.array([0, len(piece)]), keys, width, gram)
            part["at"] += at
            parts.append(part)
        return np.concatenate(parts)
    if len(data) < width:
        return np.zeros(0, _SUFFIX)
    rolling = textops.Rolling(data)
    hashes = rolling.windows(gram)
    # The hash decides, of equal ones the first place.
    chosen = _sliding_minimum((hashes & _HIGH) | np.arange(len(hashes), dtype=np.uint64), width - gram + 1)
    chosen = (chosen & _LOW).astype(np.int64)
    start = np.arange(len(data) - width + 1)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(start)]
    inside = start + width <= offsets[doc + 1]
    start, chosen, doc = start[inside], chosen[inside], doc[inside]
    if len(start) == 0:
        return np.zeros(0, _SUFFIX)
    new = np.ones(len(start), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    out = np.zeros(len(first), _SUFFIX)
    count = np.diff(np.append(first, len(start)))
    begin = start[first]
    out["t0"] = hashes[chosen[first]]
    out["t1"] = rolling.ranges(begin, begin + count - 1 + width)
    out["key"] = keys[doc[first]]
    out["at"] = begin - offsets[doc[first]]
    out["n"] = count
    return out


def windows(text: bytes, key: int, at: np.ndarray, n: np.ndarray, t0: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """A suffix for every window of the given segments of one text."""
    parts = []
    for begin, count, token in zip(at.tolist(), n.tolist(), t0.astype(np.uint64).tolist(), strict=True):
        hashes = textops.Rolling(np.frombuffer(text, np.uint8, count - 1 + width, begin)).windows(width)
        part = np.zeros(count, _SUFFIX)
        part["t0"], part["t1"], part["key"], part["n"] = token, hashes, key, 1
        part["at"] = np.arange(begin, begin + count)
        parts.append(part)
    return np.concatenate(parts) if parts else np.zeros(0, _SUFFIX)


def multikey_quicksort(tokens: list[np.ndarray], leaf: int = LEAF) -> np.ndarray:
    """The order of rows by their tokens: three-way partition by a pivot of the current token,
    going on to the next token among equal ones."""
    order: list[np.ndarray] = []
    stack = [(np.arange(len(tokens[0])), 0)]
    while stack:
        rows, depth = stack.pop()
        if len(rows) <= leaf or depth == len(tokens):
            if depth < len(tokens) and len(rows) > 1:
                rows = rows[np.lexsort([t[rows] for t in reversed(tokens[depth:])])]
            order.append(rows)
            continue
        token = tokens[depth][rows]
        pivot = np.sort(token[:: max(1, len(rows) // 9)])[4]
        less, equal = token < pivot, token == pivot
        # The stack gives the least first.
        stack.append((rows[~less & ~equal], depth))
        stack.append((rows[equal], depth + 1))
        stack.append((rows[less], depth))
    return np.concatenate(order) if order else np.zeros(0, np.int64)


def _not_after(splitters: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Splitter <= row, element by element, by all four columns."""
    result = splitters["at"] <= rows["at"]
    for name in ("key", "t1", "t0"):
        result = (splitters[name] < rows[name]) | ((splitters[name] == rows[name]) & result)
    return result


def route(rows: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """The bucket of each row: how many splitters are not after it."""
    low = np.searchsorted(splitters["t0"], rows["t0"], side="left")
    high = np.searchsorted(splitters["t0"], rows["t0"], side="right")
    open_ = np.flatnonzero(low < high)
    while len(open_):  # bisect among splitters with the row's first token
        middle = (low[open_] + high[open_]) // 2
        up = _not_after(splitters[middle], rows[open_])
        low[open_[up]] = middle[up] + 1
        high[open_[~up]] = middle[~up]
        open_ = open_[low[open_] < high[open_]]
    return low


def splitters_of(sample: np.ndarray, buckets: int) -> np.ndarray:
    """Quantiles of a sample; a frequent token may hold several of them."""
    ordered = np.sort(sample, order=["t0", "t1", "key", "at"])
    at = (np.arange(1, buckets) * len(ordered)) // buckets
    return ordered[at] if len(ordered) else ordered


def _blob(rows: np.ndarray) -> bytes:
    """Column after column, positions as differences, which compress well."""
    return b"".join([rows["t0"].tobytes(), rows["t1"].tobytes(), rows["key"].tobytes(),
                     np.diff(rows["at"], prepend=0).astype("<i8").tobytes(), rows["n"].tobytes()])


def _unblob(raw: bytes) -> np.ndarray:
    count = len(raw) // 36
    out = np.zeros(count, _SUFFIX)
    for i, name in enumerate(("t0", "t1", "key", "at")):
        out[name] = np.frombuffer(raw, "<i8" if i > 1 else "<u8", count, 8 * count * i)
    out["at"] = np.cumsum(out["at"])
    out["n"] = np.frombuffer(raw, "<i4", count, 32 * count)
    return out


_SENT = "bucket int, suffixes binary"


def _gathered(parts: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Small arrays put together, so that what goes to a bucket is worth a row."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part)
        if size >= SEND_ROWS:
            yield np.concatenate(held)
            held, size = [], 0
    if size:
        yield np.concatenate(held)


def _send(rows: np.ndarray, splitters: np.ndarray) -> pa.RecordBatch:
    """Rows as one packed value per bucket, in the order of rows and positions."""
    bucket = route(rows, splitters)
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(first[1:], len(rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[first], pa.int32()),
         pa.array([_blob(rows[a:b]) for a, b in zip(first, ends, strict=True)], pa.binary())],
        ["bucket", "suffixes"])


_FOUND = "kind string, bucket int, key bigint, at bigint, n int, t0 bigint, t1 bigint, t1_last bigint"


def _found(kind: str, bucket: int, rows: np.ndarray, last: np.ndarray | None = None) -> pa.RecordBatch:
    signed = lambda c: pa.array(c.astype(np.uint64).view(np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(rows)), pa.array(np.full(len(rows), bucket, np.int32)), pa.array(rows["key"]),
         pa.array(rows["at"]), pa.array(rows["n"]), signed(rows["t0"]), signed(rows["t1"]),
         signed(rows["t1"] if last is None else last)],
        [item.split()[0] for item in _FOUND.split(", ")])


def _runs(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row of each run, and the run of each row."""
    return np.flatnonzero(new), np.cumsum(new) - 1


def compare(bucket: int, rows: np.ndarray, partial: bool, width: int) -> Iterator[pa.RecordBatch]:
    """What the neighbours in one bucket say.

    ``repeat``: intervals that stand elsewhere, too; ``part``: one of each different segment
    whose gram another segment has as well (only if ``partial``); ``edge`` and ``alone``:
    the first and last group, and rows at the edges that nothing in the bucket equals.
    """
    rows = rows[multikey_quicksort([rows["t0"], rows["t1"]])]
    new0 = np.ones(len(rows), bool)
    new0[1:] = rows["t0"][1:] != rows["t0"][:-1]
    new1 = new0.copy()
    new1[1:] |= rows["t1"][1:] != rows["t1"][:-1]
    first1, run1 = _runs(new1)
    sizes = np.diff(np.append(first1, len(rows)))
    repeated = sizes[run1] > 1
    hits = rows[repeated]
    # Neighbouring windows of a row become one interval.
    hits = hits[np.lexsort([hits["at"], hits["key"]])]
    if len(hits):
        ends = hits["at"] + hits["n"]
        apart = np.ones(len(hits), bool)
        apart[1:] = (hits["key"][1:] != hits["key"][:-1]) | (hits["at"][1:] > ends[:-1])
        begin = np.flatnonzero(apart)
        merged = hits[begin].copy()
        merged["n"] = np.maximum.reduceat(ends, begin) - merged["at"]
        yield _found("repeat", bucket, merged)
    first0, run0 = _runs(new0)
    kinds = np.bincount(run0[first1], minlength=len(first0))
    if partial:
        several = rows[first1[kinds[run0[first1]] > 1]]
        if len(several):
            yield _found("part", bucket, several)
    for side in {0, len(first0) - 1}:
        begin = first0[side]
        end = first0[side + 1] if side + 1 < len(first0) else len(rows)
        edge = rows[begin:begin + 1]
        yield _found("edge", bucket, edge, rows["t1"][end - 1:end])
    for at in {0, len(rows) - 1}:
        yield _found("alone" if not repeated[at] else "twice", bucket, rows[at:at + 1])


def _compare_all(batches: Iterator[pa.RecordBatch], partial: bool, width: int) -> Iterator[pa.RecordBatch]:
    gathered: dict[int, list[np.ndarray]] = defaultdict(list)
    for batch in batches:
        for bucket, raw in zip(batch["bucket"].to_pylist(), batch["suffixes"].to_pylist(), strict=True):
            gathered[bucket].append(_unblob(raw))
    for bucket in sorted(gathered):
        yield from compare(bucket, np.concatenate(gathered.pop(bucket)), partial, width)


def _across_edges(found: DataFrame, partial: bool) -> DataFrame:
    """Rows at the edges of buckets that a neighbouring bucket settles.

    The driver sees at most two groups and two rows of each bucket.
    """
    small = found.filter("kind IN ('edge', 'alone', 'twice')").collect()
    ranges: dict[int, set[int]] = defaultdict(set)
    buckets: dict[tuple[int, int], set[int]] = defaultdict(set)
    for r in small:
        if r["kind"] == "edge":
            ranges[r["t0"]] |= {r["t1"], r["t1_last"]}
        else:
            buckets[r["t0"], r["t1"]].add(r["bucket"])
    settled = []
    for r in small:
        row = tuple(r)[1:]
        if r["kind"] == "alone" and len(buckets[r["t0"], r["t1"]]) > 1:
            settled.append(("repeat", *row))
        # A group that is of one kind in each bucket, but not in all: any of its rows stands for its kind.
        if partial and r["kind"] == "edge" and r["t1"] == r["t1_last"] and len(ranges[r["t0"]]) > 1:
            settled.append(("part", *row))
    return found.sparkSession.createDataFrame(settled, found.schema)


def sorted_and_compared(
    spark: SparkSession, rows: Callable[[np.ndarray], DataFrame], sample: np.ndarray, share: float,
    partial: bool, width: int,
) -> tuple[DataFrame, DataFrame]:
    """Repeated intervals and partly repeated segments of the suffixes that ``rows(splitters)`` sends."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, int(len(sample) / share / BUCKET_ROWS))
    sent = rows(splitters_of(sample, buckets))
    found = materialized(
        sent.repartitionById(buckets, "bucket").mapInArrow(lambda b: _compare_all(b, partial, width), _FOUND), "suffixes")
    both = found.filter("kind IN ('repeat', 'part')").unionByName(_across_edges(found, partial))
    repeats = both.filter("kind = 'repeat'").select("key", "at", (F.col("n") + F.lit(width - 1)).alias("length"))
    return repeats, both.filter("kind = 'part'").select("key", "at", "n", "t0")


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key that only rows of the same doc_id and text share."""
    rows = textops.documents(docs, "doc_id", "text")
    return rows.withColumn("key", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))


def _from_bytes(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), _SUFFIX) if raw else np.zeros(0, _SUFFIX)


def _sampled(rows: np.ndarray, share: float) -> np.ndarray:
    """About ``share`` of the rows, spread by a hash of all that tells them apart."""
    if share >= 1:
        return rows
    mark = textops.mix(rows["t0"] ^ textops.mix(rows["key"].astype(np.uint64) + rows["at"].astype(np.uint64)))
    return rows[mark < np.uint64(int(share * 2.0**64))]


def repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(key, at, length): intervals of bytes to remove; they may overlap."""
    spark = docs.sparkSession
    keyed = _keyed(docs)
    n_rows, n_bytes = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    per_byte = 2 / (width - gram + 2)
    share = min(1.0, SPLITTER_SAMPLE / max(1.0, n_bytes * per_byte))

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in textops.chunks(batches, limit=CHUNK_BYTES):
            data, offsets = textops.utf8(batch.column("text"))
            found = segments(data, offsets, batch.column("key").to_numpy(zero_copy_only=False), width, gram)
            if len(found):
                yield found

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in suffixes(batches):
            yield pa.RecordBatch.from_arrays([pa.array([_sampled(found, share).tobytes()], pa.binary())], ["rows"])

    def send(splitters: np.ndarray) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for found in _gathered(suffixes(batches)):
                yield _send(found, splitters)

        return keyed.select("key", "text").mapInArrow(run, _SENT)

    sample = _from_bytes([bytes(r["rows"]) for r in keyed.select("key", "text").mapInArrow(take, "rows binary").collect()])
    whole, parts = sorted_and_compared(spark, send, sample, share, True, width)

    listed = parts.groupBy("key").agg(F.collect_list(F.struct("at", "n", "t0")).alias("parts"))
    listed = materialized(listed, "parts")
    n_windows = listed.select(F.coalesce(F.sum(F.aggregate(
        "parts", F.lit(0).cast("bigint"), lambda s, p: s + p["n"])), F.lit(0))).first()[0]
    if n_windows == 0:
        return whole
    share2 = min(1.0, SPLITTER_SAMPLE / n_windows)
    texts = _packed(keyed).join(listed, "key").select("key", "body", "parts")

    def each_window(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for key, body, own in zip(*(batch.column(c) for c in ("key", "body", "parts")), strict=True):
                at, n, t0 = (own.values.field(c).to_numpy(zero_copy_only=False) for c in ("at", "n", "t0"))
                yield windows(unpack(body.as_py()), key.as_py(), at, n, t0.view(np.uint64), width)

    def take_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in each_window(batches):
            yield pa.RecordBatch.from_arrays([pa.array([_sampled(found, share2).tobytes()], pa.binary())], ["rows"])

    # Some rows of the list are enough to see where the windows lie; they are few, so no text moves.
    some = min(1.0, 8 * share2)
    few = listed if some >= 1 else listed.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(some * (1 << 20)) + 1)
    few = F.broadcast(few) if some < 1 else few
    share2 = min(1.0, share2 / some)
    sample = _from_bytes([bytes(r["rows"]) for r in (
        _packed(keyed).join(few, "key").select("key", "body", "parts").mapInArrow(take_windows, "rows binary").collect())])

    def send_windows(splitters: np.ndarray) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for found in _gathered(each_window(batches)):
                yield _send(found, splitters)

        return texts.mapInArrow(run, _SENT)

    in_part, _ = sorted_and_compared(spark, send_windows, sample, share2 * some, False, width)
    return whole.unionByName(in_part)


def _packed(keyed: DataFrame) -> DataFrame:
    """Texts compressed, as they are shuffled whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in textops.chunks(batches):
            data, at = textops.utf8(batch.column("text"))
            raw = data.tobytes()
            bodies = [pack(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), pa.array(bodies, pa.binary())], ["key", "doc_id", "body"])

    return keyed.mapInArrow(run, "key bigint, doc_id bigint, body binary")


def union(at: np.ndarray, length: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs (begin, end) of the covered bytes."""
    order = np.argsort(at, kind="stable")
    begin = at[order]
    reach = np.maximum.accumulate(begin + length[order])
    first = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]]))
    return list(zip(begin[first].tolist(), reach[np.append(first[1:], len(begin)) - 1].tolist(), strict=True))


def _with_runs(docs: DataFrame, width: int, gram: int) -> DataFrame:
    spans = repeats(docs, width, gram)
    listed = spans.groupBy("key").agg(F.collect_list(F.struct("at", "length")).alias("spans"))
    return _packed(_keyed(docs)).join(listed, "key", "left")


def _cut(body: bytes, own) -> tuple[bytes, list[tuple[int, int]], bytes]:
    """The text, its removed runs and what is left."""
    text = body
    if not own.is_valid:
        return text, [], text
    runs = union(*(own.values.field(c).to_numpy(zero_copy_only=False) for c in ("at", "length")))
    kept, at = [], 0
    for begin, end in runs:
        kept.append(text[at:begin])
        at = end
    kept.append(text[at:])
    return text, runs, b"".join(kept)


DIGEST = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def digest(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """What is removed from each row of ``docs``.

    Null and empty texts, and texts shorter than ``width``, lose nothing.  Rows that are
    repeated as a whole are copies of each other and lose all that a copy loses.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for doc_id, body, own in zip(*(batch.column(c) for c in ("doc_id", "body", "spans")), strict=True):
                text, runs, kept = _cut(unpack(body.as_py()), own)
                rows.append((doc_id.as_py(), len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if i == 4 else pa.int64()) for i, c in enumerate(columns)],
                [item.split()[0] for item in DIGEST.split(", ")])

    return _with_runs(docs, width, gram).mapInArrow(run, DIGEST)


def _free(name: str, docs: DataFrame) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` with repeated byte strings cut out of ``text``.

    Bytes of a character that is cut in two go as well.  A column ``n_chars`` is counted
    anew; the other columns stay.  Rows whose text is null keep it.
    """
    key, found = _free("_key", docs), _free("_spans", docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, own in zip(batch.column("text"), batch.column(found), strict=True):
                raw = text.as_py()
                texts.append(raw if raw is None or not own.is_valid else
                             _cut(raw.encode(), own)[2].decode("utf-8", "ignore"))
            columns = {n: batch.column(n) for n in batch.schema.names if n != found}
            columns["text"] = pa.array(texts, columns["text"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    spans = repeats(docs, width, gram)
    listed = spans.groupBy(F.col("key").alias(key)).agg(F.collect_list(F.struct("at", "length")).alias(found))
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit(""))))
    joined = keyed.join(listed, key, "left").drop(key)
    left = joined.mapInArrow(run, docs.schema)
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if (
        "n_chars" in docs.columns) else left
