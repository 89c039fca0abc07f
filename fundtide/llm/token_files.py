"""Token-ID files: patched frame-of-reference blocks with an index of block starts.

A shard file holds the ids of a range of documents::

    "PFORIDS1"
    block*      little-endian: minimum u32, count u16, width u8, 0 u8, exceptions u16,
                packed bits (count x width, low bit first), positions u16[], values u32[]
    index       documents: doc_id i64[], ids u32[]; blocks: file offset u64[]
    footer      index offset u64, documents u64, those without a doc_id u64 (they come first),
                blocks u64, ids u64, "PFORIDS1"

Each block subtracts its minimum and packs the differences with the width that holds a
given share of them; larger ones keep their low bits in place, and their values go to
the block's exception list.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundtide.llm import textops, tokenizing
from fundtide.sources.workspace import materialized, new_folder

MAGIC = b"PFORIDS1"
BLOCK = 4096
#: Share of a block's values that its width must hold.
SHARE = 0.95
_HEAD = struct.Struct("<IHBBH")
_FOOT = struct.Struct("<QQQQQ8s")


def pack_block(ids: np.ndarray, share: float = SHARE) -> bytes:
    """One block of 1 to 65535 ids."""
    low = ids.min()
    gaps = (ids - low).astype(np.uint32)
    bits = np.frexp(gaps.astype(np.float64))[1]  # bits that each difference needs; 0 for 0
    width = int(np.sort(bits)[max(0, int(np.ceil(share * len(ids))) - 1)])
    outliers = np.flatnonzero(bits > width).astype("<u2")
    digits = np.unpackbits(gaps.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    packed = np.packbits(digits.ravel(), bitorder="little").tobytes()
    head = _HEAD.pack(int(low), len(ids), width, 0, len(outliers))
    return head + packed + outliers.tobytes() + ids[outliers].astype("<u4").tobytes()


def unpack_block(raw: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """The ids of the block at byte ``at``, and where the next one begins."""
    low, count, width, _, n_out = _HEAD.unpack_from(raw, at)
    at += _HEAD.size
    size = (count * width + 7) // 8
    digits = np.zeros((count, 32), np.uint8)
    if width:
        bits = np.unpackbits(np.frombuffer(raw, np.uint8, size, at), count=count * width, bitorder="little")
        digits[:, :width] = bits.reshape(count, width)
    ids = np.packbits(digits, axis=1, bitorder="little").view("<u4").ravel() + np.uint32(low)
    at += size
    where = np.frombuffer(raw, "<u2", n_out, at)
    at += 2 * n_out
    ids[where] = np.frombuffer(raw, "<u4", n_out, at)
    return ids, at + 4 * n_out


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def located(spark: SparkSession, folder: str) -> str:
    """The folder with its file system, as Spark resolves it; one that the tasks cannot open is refused."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    try:
        _open(uri)
    except (ValueError, pa.ArrowInvalid, pa.ArrowNotImplementedError) as error:
        raise ValueError(f"token files cannot be written to {uri}: {error}") from error
    return uri


class ShardWriter:
    """Writes one shard; memory holds one block and the index."""

    def __init__(self, stream):
        self._out, self._rest = stream, np.zeros(0, np.uint32)
        self.doc_ids: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self._blocks: list[int] = []
        self._at = stream.write(MAGIC) or len(MAGIC)
        self.n_ids = self.nameless = 0

    def add(self, doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, nameless: int = 0) -> None:
        """Documents in order; the first ``nameless`` have no doc_id, and none before them has one."""
        self.nameless += nameless
        self.doc_ids.append(doc_ids.astype("<i8"))
        self.counts.append(counts.astype("<u4"))
        self.n_ids += len(ids)
        ids = np.concatenate([self._rest, ids])
        full = len(ids) // BLOCK * BLOCK
        for k in range(0, full, BLOCK):
            self._block(ids[k:k + BLOCK])
        self._rest = ids[full:]

    def _block(self, ids: np.ndarray) -> None:
        raw = pack_block(ids)
        self._blocks.append(self._at)
        self._out.write(raw)
        self._at += len(raw)

    def close(self) -> None:
        if len(self._rest):
            self._block(self._rest)
        join = lambda parts, kind: (np.concatenate(parts) if parts else np.zeros(0)).astype(kind)
        docs = join(self.doc_ids, "<i8")
        self._out.write(docs.tobytes() + join(self.counts, "<u4").tobytes() + np.array(self._blocks, "<u8").tobytes())
        self._out.write(_FOOT.pack(self._at, len(docs), self.nameless, len(self._blocks), self.n_ids, MAGIC))
        self._out.close()


class ShardReader:
    """Random access to a shard: whole documents in order, or any range of ids."""

    def __init__(self, file):
        self._file = file
        size = file.size()
        if size < len(MAGIC) + _FOOT.size or file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a token-ID file")
        self._end, docs, self.nameless, blocks, self.n_ids, magic = _FOOT.unpack(file.read_at(_FOOT.size, size - _FOOT.size))
        if magic != MAGIC:
            raise ValueError("not a complete token-ID file")
        raw = file.read_at(12 * docs + 8 * blocks, self._end)
        self.doc_ids = np.frombuffer(raw, "<i8", docs)
        self.counts = np.frombuffer(raw, "<u4", docs, 8 * docs).astype(np.int64)
        self.blocks = np.frombuffer(raw, "<u8", blocks, 12 * docs)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids ``start:stop`` of the shard, from the blocks that hold them."""
        start, stop = max(0, start), min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (stop - 1) // BLOCK
        begin = int(self.blocks[first])
        end = int(self.blocks[last + 1]) if last + 1 < len(self.blocks) else self._end
        raw, at, parts = self._file.read_at(end - begin, begin), 0, []
        for _ in range(first, last + 1):
            ids, at = unpack_block(raw, at)
            parts.append(ids)
        return np.concatenate(parts)[start - first * BLOCK:stop - first * BLOCK]

    def documents(self, ids_at_a_time: int = 1 << 20) -> Iterator[tuple[int | None, int, int, int]]:
        """doc_id (None without one), start in the shard, number of ids and their crc32, in order."""
        ends = np.cumsum(self.counts)
        k = 0
        while k < len(ends):
            begin = int(ends[k] - self.counts[k])
            stop = max(k + 1, int(np.searchsorted(ends, begin + ids_at_a_time, side="right")))
            ids = self.ids(begin, int(ends[stop - 1])).astype("<u4")
            for d in range(k, stop):
                own = int(ends[d] - self.counts[d])
                yield None if d < self.nameless else int(self.doc_ids[d]), own, int(self.counts[d]), zlib.crc32(ids[own - begin:ends[d] - begin])
            k = stop


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Encode every document and write shard files of ascending doc_id into ``folder``.

    Rows without a doc_id come first; a null text is empty; repeated doc_ids are kept in the
    order of a hash of their texts, so they may spread over files.  A task writes its range of
    documents to a file of its own name, so a repeated task never touches another's file;
    only files that the returned manifest names count.  Manifest: file, place (its number in
    the order), n_docs, n_ids.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        encode = tokenizing.encoder(tokenizer_path).encode
        writer = None
        for batch in textops.chunks(batches, limit=tokenizing.CHUNK_BYTES, kind=tokenizing.KIND):
            if writer is None:
                where, base = _open(folder)
                where.create_dir(base, recursive=True)
                name = f"ids-{uuid.uuid4().hex}.pfor"
                writer = ShardWriter(where.open_output_stream(f"{base}/{name}"))
            ids, at = encode(*textops.utf8(batch.column("text")))
            doc_ids = pc.fill_null(batch.column("doc_id"), 0).to_numpy(zero_copy_only=False)
            writer.add(doc_ids, np.diff(at) + 1, np.insert(ids, at[1:], np.uint32(end_id)), batch.column("doc_id").null_count)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({
                "file": [name], "place": [TaskContext.get().partitionId()],
                "n_docs": [sum(map(len, writer.doc_ids))], "n_ids": [writer.n_ids],
            })

    folder = located(docs.sparkSession, folder)
    rows = textops.documents(docs, "doc_id", "text").withColumn("mark", F.xxhash64("text"))
    placed = rows.repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark", "text").select("doc_id", "text")
    return materialized(placed.mapInArrow(write, "file string, place bigint, n_docs bigint, n_ids bigint"), "manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start among all ids, n_tokens and ids_crc32 of every document, from the files."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(batch["file"].to_pylist(), batch["before"].to_pylist(), strict=True):
                where, base = _open(folder)
                with where.open_input_file(f"{base}/{name}") as file:
                    rows = list(ShardReader(file).documents())
                doc_id, start, count, crc = (list(c) for c in zip(*rows, strict=True)) if rows else ([],) * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_id, pa.int64()), pa.array(np.array(start, np.int64) + before),
                     pa.array(count, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    folder = located(manifest.sparkSession, folder)
    # One row per file: the window has as many rows as there are files.
    order = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))
    n = max(1, manifest.count())
    return files.select("file", "before").repartition(n).mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_file_digest(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write the files to the shared folder and read every document back from them."""
    folder = new_folder(docs.sparkSession, "token-ids")
    return read_token_files(write_token_files(docs, folder, tokenizer_path, end_id), folder)
