"""Near duplicates by ProbMinHash over weighted word shingles, banding and verification.

Similarity is the probability Jaccard index of the shingle counts.  The arrivals of a
Poisson process per shingle, at the rate of its count, fill the registers of a signature;
a shingle stops as soon as its next arrival is later than every register, so long texts
cost little more than one arrival per shingle.  Equal registers of two texts estimate
the index.

Texts with the same words are one *text* from the start.  Texts that agree in a whole
band are candidates.  A bucket is never expanded into all pairs: its texts are compared
with a few pivots.  What this does not connect - texts outside a bucket's largest component -
meets the rest of its bucket in blocks of bounded size, which give links only; the blocks of
one bucket go to many tasks, a shelf of them to each.  Pivot pairs are first judged by their signatures.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundtide.llm import textops
from fundtide.llm.graph import extended
from fundtide.sources.workspace import materialized

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 6
REGISTERS = BANDS * ROWS
PIVOTS = 3
CHUNK_BYTES = 2 << 20
#: Rounds of pivots at most; none but the first when no more pairs are open than texts times this.
ROUNDS, OPEN_PAIRS = 6, 200
#: Texts in a block, and blocks that one task of a bucket compares with others.
BLOCK, SHELF = 64, 8
#: Texts whose shingles are asked for by broadcasting their doc_ids (32 bytes each, so at most 6.4 MB, less
#: than Spark broadcasts by itself); more meet their documents by a shuffle.
FEW_TEXTS = 200_000
#: Pairs whose signatures agree in less than this share of the registers are not near: at a
#: similarity of THRESHOLD that is more than seven standard deviations off.
LEAST_AGREEING = -(-REGISTERS * 55 // 100)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, ...]:
    """Each different shingle of each text: text, hash, count; and two hashes of each text's words.

    A text of fewer words than ``size`` has one shingle of them all; one without words has none.
    """
    n = len(offsets) - 1
    starts, ends, doc = textops.words(data, offsets)
    words = textops.Rolling(data).ranges(starts, ends)
    hashes, owner = textops.grams(words, doc, size)
    n_words = np.bincount(doc, minlength=n)
    place = np.arange(len(doc)) - np.searchsorted(doc, doc)
    salted = textops.mix(words ^ textops.mix(place.astype(np.uint64)))
    identity = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
    full = np.flatnonzero(n_words)
    first = np.searchsorted(doc, full)
    if len(full):
        identity[0][full] = textops.mix(np.add.reduceat(salted, first) + n_words[full].astype(np.uint64))
        identity[1][full] = textops.mix(np.bitwise_xor.reduceat(textops.mix(salted), first))
    short = full[n_words[full] < size]
    hashes, owner = np.concatenate([hashes, identity[0][short]]), np.concatenate([owner, short])
    order = np.lexsort([hashes, owner])
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], hashes[at], np.diff(np.append(at, len(hashes))), *identity


def signatures(owner: np.ndarray, hashes: np.ndarray, counts: np.ndarray, n: int,
               registers: int = REGISTERS) -> np.ndarray:
    """Per text and register the shingle that arrives first (its hash); texts without shingles have zeros."""
    arrival = np.full(n * registers, np.inf)
    element = np.zeros(n * registers, np.uint64)
    time = np.zeros(len(owner))
    rate = counts.astype(float)
    # Later than every register can be: a text without shingles is never open.
    latest = np.full(n, np.inf)
    turn = 0
    while len(owner):
        turn += 1
        draw = textops.mix(hashes + np.uint64(turn * 0x9E3779B97F4A7C15 % (1 << 64)))
        time = time - np.log(((draw >> np.uint64(11)).astype(float) + 1) * 2.0**-53) / rate
        slot = owner * registers + (textops.mix(draw) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(arrival, slot, time)
        won = arrival[slot] == time
        element[slot[won]] = hashes[won]
        if turn < 6 or turn % 8 == 0:
            seen = np.unique(owner)
            latest[seen] = arrival.reshape(n, registers)[seen].max(axis=1)
        going = time < latest[owner]
        owner, hashes, rate, time = owner[going], hashes[going], rate[going], time[going]
    return element.reshape(n, registers)


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per text and band."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), bands)).copy()
    for r in range(rows):
        key = textops.mix(key * np.uint64(0x100000001B3) + parts[:, :, r])
    return key


def similarity(a: np.ndarray, a_count: np.ndarray, b: np.ndarray, b_count: np.ndarray) -> float:
    """Probability Jaccard index of two weighted sets; hashes are sorted and different."""
    if len(a) == 0 or len(b) == 0:
        return 1.0 if len(a) == len(b) else 0.0
    every = np.union1d(a, b)
    wa, wb = np.zeros(len(every)), np.zeros(len(every))
    wa[np.searchsorted(every, a)] = a_count
    wb[np.searchsorted(every, b)] = b_count
    both = (wa > 0) & (wb > 0)
    pairs, times = np.unique(np.column_stack([wa[both], wb[both]]), axis=0, return_counts=True)
    return float(sum(t / np.maximum(wa / x, wb / y).sum() for (x, y), t in zip(pairs, times, strict=True)))


_SIGNED = "key bigint, doc_id bigint, h1 bigint, h2 bigint, bands array<bigint>, marks binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    signed = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64).ravel())
    for batch in textops.chunks(batches, limit=CHUNK_BYTES):
        n = batch.num_rows
        owner, hashes, counts, h1, h2 = shingles(*textops.utf8(batch.column("text")))
        signature = signatures(owner, hashes, counts, n)
        keys = band_keys(signature)
        # Sixteen bits of each register are enough to compare signatures.
        marks = [row.tobytes() for row in (signature >> np.uint64(48)).astype("<u2")]
        # Texts without words share nothing with others.
        some = np.zeros(n, bool)
        some[owner] = True
        ends = np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(ends), signed(keys[some]))
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("doc_id"), signed(h1), signed(h2), bands,
                                          pa.array(marks, pa.binary())],
                                         ["key", "doc_id", "h1", "h2", "bands", "marks"])


_SETS = "id bigint, hashes binary, counts binary"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of the wanted texts.  32 bits of a hash tell the shingles of two texts apart."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        texts = [unpack(b) if packed else b for b, packed in zip(
            batch.column("body").to_pylist(), batch.column("packed").to_pylist(), strict=True)]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        data = np.frombuffer(b"".join(texts), np.uint8)
        rows = []
        for i in range(batch.num_rows):
            own = data[offsets[i]:offsets[i + 1]]
            _, hashes, counts, h1, h2 = shingles(own, np.array([0, len(own)]))
            if (int(h1.view(np.int64)[0]), int(h2.view(np.int64)[0])) != (batch["h1"][i].as_py(), batch["h2"][i].as_py()):
                continue  # another text with the same doc_id
            short = (hashes >> np.uint64(32)).astype("<u4")
            order = np.argsort(short, kind="stable")
            merged, at = np.unique(short[order], return_index=True)
            rows.append((batch["id"][i].as_py(), merged.tobytes(),
                         np.add.reduceat(counts[order], at).astype("<u4").tobytes() if len(at) else b""))
        columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())],
            ["id", "hashes", "counts"])


def _packed(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in textops.chunks(batches):
            data, at = textops.utf8(batch.column("text"))
            raw = data.tobytes()
            bodies = [pack(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bodies, pa.binary())], ["doc_id", "body"])

    return docs.mapInArrow(run, "doc_id bigint, body binary")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [[np.frombuffer(v.as_py(), "<u4") for v in batch.column(c)]
                 for c in ("a_hashes", "a_counts", "b_hashes", "b_counts")]
        value = [similarity(*row) for row in zip(*parts, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(value, pa.float64())],
                                         ["a", "b", "similarity"])


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree often enough."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("ma", "mb"))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(
            pa.array((a == b).sum(axis=1) >= LEAST_AGREEING))


def _near_in_blocks(a: list[dict], b: list[dict], threshold: float) -> Iterator[tuple[int, int, float]]:
    """Near pairs of texts of two blocks that are not in one component.

    For texts without a repeated shingle the index is common / all shingles, for all pairs of
    the blocks at once.  Of other pairs no more than the smaller shares of the common shingles
    can count, and what could reach the threshold that way is computed one by one.
    """
    def columns(block: list[dict]) -> tuple[list, list, np.ndarray, np.ndarray, np.ndarray]:
        hashes = [np.frombuffer(t["hashes"], "<u4") for t in block]
        counts = [np.frombuffer(t["counts"], "<u4") for t in block]
        owner = np.repeat(np.arange(len(block)), list(map(len, hashes)))
        share = np.concatenate([c / max(1, c.sum()) for c in counts]) if block else np.zeros(0)
        return hashes, counts, owner, np.concatenate(hashes), share

    ha, ca, oa, xa, sa = columns(a)
    hb, cb, ob, xb, sb = columns(b)
    order = np.argsort(xb, kind="stable")
    xb, ob, sb = xb[order], ob[order], sb[order]
    low, high = np.searchsorted(xb, xa, side="left"), np.searchsorted(xb, xa, side="right")
    size = high - low
    at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
    pair, shape = np.repeat(oa, size) * len(b) + ob[at], (len(a), len(b))
    common = np.bincount(pair, minlength=len(a) * len(b)).reshape(shape)
    most = np.bincount(pair, np.minimum(np.repeat(sa, size), sb[at]), len(a) * len(b)).reshape(shape)
    na, nb = (np.array(list(map(len, h))) for h in (ha, hb))
    once_a, once_b = (np.array([bool((c == 1).all()) for c in counts]) for counts in (ca, cb))
    plain = once_a[:, None] & once_b
    index = np.where(plain, common / np.maximum(na[:, None] + nb - common, 1), most)
    apart = np.array([t["component"] for t in a])[:, None] != np.array([t["component"] for t in b])
    for i, j in np.argwhere(apart & (index >= threshold - 1e-9)).tolist():
        value = index[i, j] if plain[i, j] else similarity(ha[i], ca[i], hb[j], cb[j])
        if value >= threshold:
            yield a[i]["id"], b[j]["id"], float(value)


class _Comparer:
    """The near ones of pairs of texts; pairs are compared once, and shingles kept once they were needed."""

    def __init__(self, docs: DataFrame, texts: DataFrame, threshold: float):
        self._docs, self._texts, self._threshold = docs, texts, threshold
        self._sets: DataFrame | None = None
        self._seen: DataFrame | None = None

    def _know(self, ids: DataFrame) -> None:
        """Have the shingles of these texts."""
        wanted = ids.distinct()
        if self._sets is not None:
            wanted = wanted.join(self._sets.select("id"), "id", "left_anti")
        listed = materialized(self._texts.join(wanted, "id").select("id", "h1", "h2", "first_doc"), "wanted")
        same = F.col("doc_id").eqNullSafe(F.col("first_doc"))
        if listed.count() <= FEW_TEXTS:
            body = F.coalesce("text", F.lit("")).cast("binary").alias("body")
            found = self._docs.join(F.broadcast(listed), same).select("id", "h1", "h2", body, F.lit(False).alias("packed"))
        else:
            found = _packed(self._docs).join(listed, same).select("id", "h1", "h2", "body", F.lit(True).alias("packed"))
        new = materialized(found.mapInArrow(_sets, _SETS).dropDuplicates(["id"]), "sets")
        self._sets = new if self._sets is None else self._sets.unionByName(new)

    def in_blocks(self, outside: DataFrame, members: DataFrame) -> DataFrame:
        """Links between ``outside`` and ``members`` (key, id, component) of the same key and other components."""
        threshold = self._threshold
        self._know(members.select("id"))
        counts = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("blocks"))

        def blocks(part: DataFrame, name: str) -> DataFrame:
            dealt = part.join(counts, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
            return dealt.join(self._sets, "id").groupBy("key", "blocks", "block").agg(
                F.collect_list(F.struct("id", "component", "hashes", "counts")).alias(name))

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for one, two in zip(batch.column("one"), batch.column("two"), strict=True):
                    found = list(_near_in_blocks(one.as_py(), two.as_py(), threshold))
                    if found:
                        a, b, value = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(value, pa.float64())],
                            ["a", "b", "similarity"])

        # A bucket's blocks stand on shelves; a block from outside goes to every shelf of its
        # bucket, so no task has more than one shelf of it.
        shelves = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("blocks") - 1) / SHELF))
        one = blocks(outside, "one").select("key", F.explode(shelves).alias("shelf"), "one")
        two = blocks(members, "two").select("key", F.floor(F.col("block") / SHELF).alias("shelf"), "two")
        both = one.join(two, ["key", "shelf"]).select("one", "two")
        found = both.mapInArrow(compare, "a bigint, b bigint, similarity double")
        return materialized(found.dropDuplicates(["a", "b"]), "links")

    def __call__(self, pairs: DataFrame) -> DataFrame:
        if self._seen is not None:
            pairs = pairs.join(self._seen, ["a", "b"], "left_anti")
        pairs = materialized(pairs, "pairs")
        self._seen = pairs if self._seen is None else self._seen.unionByName(pairs)
        mark = lambda c: self._texts.select(F.col("id").alias(c), F.col("marks").alias(f"m{c}"))
        likely = materialized(
            pairs.join(mark("a"), "a").join(mark("b"), "b").mapInArrow(_likely, "a bigint, b bigint"), "likely")

        self._know(likely.select(F.col("a").alias("id")).unionByName(likely.select(F.col("b").alias("id"))))
        side = lambda c: self._sets.select(*[F.col(x).alias(y) for x, y in (
            ("id", c), ("hashes", f"{c}_hashes"), ("counts", f"{c}_counts"))])
        compared = likely.join(side("a"), "a").join(side("b"), "b").mapInArrow(
            _verify, "a bigint, b bigint, similarity double")
        return materialized(compared.filter(F.col("similarity") >= self._threshold), "links")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def _pivots(members: DataFrame, turn: int) -> DataFrame:
    """(key, pivot, pivot_component): a few members of each bucket, by hashes that all buckets share."""
    least = [F.min(F.struct(F.xxhash64("id", F.lit(100 * turn + k)), "id", "component")).alias(f"p{k}") for k in range(PIVOTS)]
    found = members.groupBy("key").agg(*least)
    chosen = F.array_distinct(F.array(*[
        F.struct(F.col(f"p{k}.id").alias("id"), F.col(f"p{k}.component").alias("component")) for k in range(PIVOTS)]))
    return found.select("key", F.explode(chosen).alias("p")).select(
        "key", F.col("p.id").alias("pivot"), F.col("p.component").alias("pivot_component"))


def _still_open(placed: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Members of the buckets that are not connected, those outside the bucket's largest
    component, and how many pairs these make with the bucket's members."""
    main = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(
        F.count(F.lit(1)).alias("kinds"), F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("size"),
    ).filter("kinds > 1").select("key", F.col("top.component").alias("main"), "size")
    members = materialized(placed.join(main, "key"), "open")
    outside = members.filter("component <> main")
    pairs = outside.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    return members.drop("main", "size"), outside.drop("main", "size"), pairs


def connected(docs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id, component) of the texts that are linked, by links that connect all that links within buckets connect.

    Two texts of a bucket that are near but in no pair here are in one component all the same.
    Pivots after the first round come from outside the bucket's largest component, and are then
    done: they were compared with all texts that they are not connected with.
    """
    compare = _Comparer(docs, texts, threshold)
    members = materialized(texts.select(F.explode("bands").alias("key"), "id"), "members")
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("key")
    members = materialized(members.join(shared, "key").withColumn("component", F.col("id")), "members")
    limit = max(1000, OPEN_PAIRS * texts.count())
    found: DataFrame | None = None  # (id, component)
    outside, turn = members, 0
    while True:
        meet = members.join(_pivots(outside, turn), "key").filter("component <> pivot_component")
        new = compare(_ordered(meet.select(F.col("pivot").alias("a"), F.col("id").alias("b"))))
        found = extended(found, new)
        placed = members.drop("component").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
        members, outside, open_pairs = _still_open(placed)
        turn += 1
        if open_pairs <= limit or turn == ROUNDS:
            break
    if open_pairs:
        found = extended(found, compare.in_blocks(outside, members))
    return found


def _row_key() -> Column:
    """The same for rows of one doc_id and text only."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def _classes(docs: DataFrame, threshold: float) -> DataFrame:
    """key, doc_id, class_id and kept for every row."""
    rows = textops.documents(docs, "doc_id", "text")
    signed = materialized(rows.withColumn("key", _row_key()).mapInArrow(_sign, _SIGNED), "signatures")
    texts = materialized(
        signed.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc"), F.first("bands").alias("bands"),
                                     F.first("marks").alias("marks"))
        .withColumn("id", F.monotonically_increasing_id()), "texts")
    found = connected(rows, texts, threshold)
    placed = texts.select("h1", "h2", "id", "first_doc").join(found, "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    leads = placed.groupBy("component").agg(F.min("first_doc").alias("class_id"))
    named = materialized(placed.join(leads, "component").select("h1", "h2", "component", "class_id"), "named")
    out = signed.select("key", "doc_id", "h1", "h2").join(named, ["h1", "h2"])
    # Of the rows with the class's doc_id, one; they are few unless a doc_id is repeated.
    is_first = F.col("doc_id").eqNullSafe(F.col("class_id"))
    lead = out.filter(is_first).groupBy("component").agg(F.min(F.struct("h1", "h2", "key")).alias("lead"))
    return out.join(lead, "component").select(
        "key", "doc_id", "class_id", (is_first & (F.struct("h1", "h2", "key") == F.col("lead"))).alias("kept"))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id and kept for every row of ``docs``.

    ``class_id`` is the least doc_id of the class (null if it has none); ``kept`` marks the
    row that stands for the class, and its exact repetitions.  Null and empty texts have the
    same words, none, and so are copies of each other.
    """
    return _classes(docs, threshold).drop("key")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs``, all columns, of each class."""
    kept = _classes(docs, threshold).filter("kept").select(F.col("key").alias("row_key")).distinct()
    # The row travels in a struct, so its columns may have any names.
    found = docs.select(_row_key().alias("row_key"), F.struct("*").alias("row")).join(kept, "row_key", "left_semi")
    # Rows of one key are repetitions of one row.
    return found.groupBy("row_key").agg(F.first("row").alias("row")).select("row.*")
