"""Benchmark decontamination by latent semantic retrieval.

Benchmark items and document passages are TF-IDF vectors over words; a randomised SVD,
computed over the passages of all documents and all items, gives a basis.  Every passage
of every document is projected and compared with every item by cosine.  What is near
enough is checked word by word: the longest common subsequence with the item, and
whether the item's answer (its last sentence) is there, too.  Items that the basis
does not hold are searched for by their words instead, which finds all that the check
by words can pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtide.llm import textops
from fundtide.sources.workspace import materialized

#: Words of a half passage; a passage is two halves, and passages overlap by one.
HALF = 24
#: Rank of the basis: what the items span and some more, within bounds.
RANK_MARGIN, RANK_LEAST, RANK_MOST, POWER_STEPS = 56, 128, 1024, 2
#: Items that are compared at a time.
ITEM_BLOCK = 4096
#: Own features for the words of the items, up to this many; all other words share the rest.
ITEM_FEATURES, OTHER_FEATURES, SLOT_BITS = 1 << 15, 1 << 13, 20
MIN_COSINE = 0.3
#: Items of which the basis holds a smaller share than this are searched for by their words, and
#: those of more than LONG words, as their cosine with a passage falls with their length;
#: so many pairs of a word and an item are looked at in one go.
CAPTURED, LONG, PAIRS_AT_A_TIME = 0.9, 4 * HALF, 1 << 22
#: Share of an item's words in order that proves a copy, or does so when the answer is there.
COPY_SHARE, PARAPHRASE_SHARE, ANSWER_SHARE = 0.8, 0.6, 0.6
#: So many words' rows of the basis, or runs, are worked on at a time, to stay in the processor's cache;
#: so many features of a task's share are sent as one value.
_WORDS_AT_A_TIME, _RUNS_AT_A_TIME, _ROWS_SENT = 1 << 10, 1 << 12, 256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_SOLID = np.zeros(256, bool)
_SOLID[ord("0"):ord("9") + 1] = _SOLID[ord("a"):ord("z") + 1] = True
_SOLID[0x80:] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (letters and digits, ASCII in lower case) and the index of its text."""
    lower = _LOWER[data]
    starts, ends, doc = textops.words(lower, offsets, _SOLID[lower])
    return textops.Rolling(lower).ranges(starts, ends), doc


@dataclass
class Items:
    ids: list[int]
    words: list[np.ndarray]
    answers: list[np.ndarray]

    @staticmethod
    def read(benchmark: DataFrame) -> Items:
        """The stated items; those without a word match nothing.  Equal rows count once."""
        rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
        rows = sorted({(r["item_id"], r["text"]) for r in rows.filter("item_id IS NOT NULL AND text IS NOT NULL").collect()})
        found = Items([], [], [])
        for item, text in rows:
            hashes = word_hashes(*textops.utf8(pa.array([text])))[0]
            if len(hashes) == 0:
                continue
            pieces = [p for p in text.replace("?", ".").replace("!", ".").replace("\n", ".").split(".") if p.strip()]
            answer = word_hashes(*textops.utf8(pa.array([pieces[-1] if pieces else text])))[0]
            found.ids.append(item)
            found.words.append(hashes)
            found.answers.append(answer if len(answer) else hashes)
        return found


@dataclass
class Features:
    """Words to features: own ones for the words of items, shared ones for all others."""

    slot: np.ndarray
    size: int

    @staticmethod
    def of(items: Items) -> Features:
        own = np.unique(np.concatenate([w >> np.uint64(64 - SLOT_BITS) for w in items.words])).astype(np.int64)
        slot = ITEM_FEATURES + np.arange(1 << SLOT_BITS) % OTHER_FEATURES
        slot[own] = np.arange(len(own)) % ITEM_FEATURES
        used = min(len(own), ITEM_FEATURES)
        slot = np.where(slot >= ITEM_FEATURES, slot - ITEM_FEATURES + used, slot)
        return Features(slot.astype(np.int32), used + OTHER_FEATURES)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        return self.slot[(hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]


def halves(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of each run of HALF words of a text, and its text."""
    begins = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])[:len(doc)])
    place = np.arange(len(doc)) - np.repeat(begins, np.diff(np.append(begins, len(doc))))
    first = np.flatnonzero(place % HALF == 0)
    return first, doc[first]


def _segment_sums(rows: np.ndarray, feature: np.ndarray, weight: np.ndarray | None, first: np.ndarray) -> np.ndarray:
    """For each run of words from ``first`` on, the sum of weight times rows[feature]; in blocks of runs."""
    out = np.zeros((len(first), rows.shape[1]), rows.dtype)
    ends = np.append(first[1:], len(feature))
    longest = int((ends - first).max()) if len(first) else 0
    step = max(1, _WORDS_AT_A_TIME // max(1, longest))
    for a in range(0, len(first), step):
        at = first[a:a + step, None] + np.arange(longest)
        inside = at < ends[a:a + step, None]
        factor = inside.astype(rows.dtype)
        at = np.minimum(at, len(feature) - 1)
        if weight is not None:
            factor *= weight[at]
        # One small product per run: its words' factors times their rows.
        out[a:a + step] = (factor[:, None, :] @ rows[feature[at]])[:, 0]
    return out


def _passage_vectors(halved: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Passage i: half i and the next one of the same text."""
    out = halved.copy()
    same = np.flatnonzero(owner[:-1] == owner[1:])
    out[same] += halved[same + 1]
    return out


def encoded(docs: DataFrame, features: Features) -> DataFrame:
    """The features of all words of all texts, in rows of many texts, and the words of each half passage."""
    shared = textops.shared(docs.sparkSession, features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.chunks(batches):
            hashes, doc = word_hashes(*textops.utf8(batch.column("text")))
            if len(hashes):
                first, _ = halves(doc)
                sizes = np.diff(np.append(first, len(hashes))).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shared.value(hashes).astype(np.uint16).tobytes()], pa.binary()), pa.array([sizes.tobytes()], pa.binary())],
                    ["words", "sizes"])

    return docs.select("text").mapInArrow(run, "words binary, sizes binary")


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature of each word and first word of each half passage, row by row of what :func:`encoded` gives."""
    for batch in textops.chunks(batches, "words"):
        for words, sizes in zip(batch.column("words"), batch.column("sizes"), strict=True):
            sizes = np.frombuffer(sizes.as_buffer(), np.uint8).astype(np.int64)
            yield np.frombuffer(words.as_buffer(), np.uint16), np.cumsum(sizes) - sizes


def _frequency(coded: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """In how many half passages each of ``size`` features occurs, and how many there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(size, np.int64), 0
        for feature, first in _decoded(batches):
            ends = np.append(first[1:], len(feature))
            # One row per half passage, in order, so that what is there twice is side by side.
            table = np.full((len(first), HALF), size, np.uint16)
            table[np.arange(HALF) < (ends - first)[:, None]] = feature
            table.sort(axis=1)
            new = np.ones(table.shape, bool)
            new[:, 1:] = table[:, 1:] != table[:, :-1]
            total += np.bincount(table[new], minlength=size + 1)[:size]
            n += len(first)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1)), pa.array(np.append(total, n))], ["feature", "n"])

    table = np.zeros(size + 1, np.int64)
    for r in coded.mapInArrow(run, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).collect():
        table[r["feature"]] = r["n"]
    return table[:-1], int(table[-1])


def document_frequency(docs: DataFrame, features: Features) -> tuple[np.ndarray, int]:
    """In how many half passages of all documents each feature occurs, and how many there are."""
    return _frequency(encoded(docs, features), features.size)


def _normal(feature: np.ndarray, first: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weight of each word in its run, so that the run's TF-IDF vector has about length one."""
    weight = idf[feature]
    norm = np.sqrt(np.add.reduceat(weight**2, first))
    return weight / np.maximum(np.repeat(norm, np.diff(np.append(first, len(feature)))), 1e-9)


def _add_transposed(feature: np.ndarray, weight: np.ndarray, first: np.ndarray, y: np.ndarray, out: np.ndarray) -> None:
    """Adds to out[f] the weight times the run's row of ``y``, for every word of feature f."""
    run_of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(feature))))
    order = np.argsort(feature, kind="stable")
    run_of, weight, ranked = run_of[order], weight[order], feature[order]
    heads = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    count = np.diff(np.append(heads, len(ranked)))
    # Features that occur about equally often together: little is filled up.
    size = np.ceil(2 * np.log2(count)).astype(int)
    for s in np.unique(size):
        own = np.flatnonzero(size == s)
        longest = int(count[own].max())
        step = max(1, _WORDS_AT_A_TIME // longest)
        for a in range(0, len(own), step):
            part = own[a:a + step]
            at = heads[part, None] + np.arange(longest)
            factor = np.where(np.arange(longest) < count[part, None], weight[np.minimum(at, len(ranked) - 1)], 0)
            rows = y[run_of[np.minimum(at, len(ranked) - 1)]]
            out[ranked[heads[part]]] += rows[:, 0] * factor if longest == 1 else (factor[:, None, :] @ rows)[:, 0]


def basis(coded: DataFrame, items: Items, features: Features, idf: np.ndarray, n_runs: int) -> np.ndarray:
    """Leading right singular vectors (features x rank) of the passages, by a randomised SVD.

    Rows are the half passages of all documents (``coded``, see :func:`encoded`; ``n_runs`` of
    them) and all items, which together weigh four times as much.  A step multiplies by the
    matrix and its transpose; tasks add up their share, and Spark adds up the tasks'.
    """
    spark = coded.sparkSession
    rank = min(features.size, RANK_MOST, max(RANK_LEAST, len(items.ids) + RANK_MARGIN))
    rng = np.random.default_rng(11)
    q = np.linalg.qr(rng.normal(size=(features.size, rank)))[0]
    item_words = features(np.concatenate(items.words))
    item_first = np.concatenate([[0], np.cumsum([len(w) for w in items.words])[:-1]]).astype(np.int64)
    item_weight = _normal(item_words, item_first, idf).astype(np.float32)
    scale = 4.0 * max(1, n_runs) / len(items.ids)

    def add_product(feature: np.ndarray, weight: np.ndarray, first: np.ndarray, q: np.ndarray, out: np.ndarray) -> None:
        """Adds A'(A q) to ``out``."""
        for a in range(0, len(first), _RUNS_AT_A_TIME):
            begin = first[a]
            end = first[a + _RUNS_AT_A_TIME] if a + _RUNS_AT_A_TIME < len(first) else len(feature)
            part, own = slice(begin, end), first[a:a + _RUNS_AT_A_TIME] - begin
            y = _segment_sums(q, feature[part], weight[part], own)
            _add_transposed(feature[part], weight[part], own, y, out)

    # A task sends as much as the basis has, so there are no more of them than work at a time.
    coded = coded.coalesce(spark.sparkContext.defaultParallelism)

    def step(q: np.ndarray) -> np.ndarray:
        q = q.astype(np.float32)
        shared = spark.sparkContext.broadcast((q, idf))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, weights = shared.value
            out = np.zeros_like(own)
            for feature, first in _decoded(batches):
                add_product(feature, _normal(feature, first, weights).astype(np.float32), first, own, out)
            for a in range(0, len(out), _ROWS_SENT):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a]), pa.array([out[a:a + _ROWS_SENT].tobytes()], pa.binary())], ["block", "part"])

        def add(batch: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(v.as_buffer(), np.float32).astype(float) for v in batch.column("part"))
            return pa.table({"block": [batch.column("block")[0].as_py()], "part": [total.astype(np.float32).tobytes()]})

        total = np.zeros_like(q)
        add_product(item_words, item_weight, item_first, q, total)
        total *= scale
        for r in coded.mapInArrow(run, "block bigint, part binary").groupBy("block").applyInArrow(
                add, "block bigint, part binary").toLocalIterator():
            total[r["block"]:r["block"] + _ROWS_SENT] += np.frombuffer(r["part"], np.float32).reshape(-1, rank)
        shared.destroy()
        return total

    for _ in range(POWER_STEPS):
        # The left singular vectors of A'A q span what q has turned to, the leading ones first.
        q = np.linalg.svd(step(q), full_matrices=False)[0]
    return q


def _stretch(size: int | np.ndarray) -> int | np.ndarray:
    """Words of a text in which an item of ``size`` words is looked for."""
    return np.maximum(size + 4, size * 3 // 2)


@dataclass
class RareWords:
    """The rarest words of items, which find every stretch that can pass the check by words.

    A stretch that passes has at least ``need`` = PARAPHRASE_SHARE of an item's n words, so of any
    n - need + m of them it has at least m.
    """

    words: np.ndarray  # sorted hashes
    starts: np.ndarray  # where the items of each word begin; one more than words
    items: np.ndarray
    least: np.ndarray  # m of each item of the benchmark
    reach: np.ndarray  # length of the stretch, likewise

    @staticmethod
    def of(items: Items, chosen: np.ndarray, frequency: Callable[[np.ndarray], np.ndarray]) -> RareWords:
        size = np.array([len(w) for w in items.words])
        need = np.ceil(PARAPHRASE_SHARE * size - 1e-9).astype(np.int64)
        least = np.maximum(1, need // 2)
        words, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for k in chosen:
            own = items.words[k]
            own = np.unique(own[np.argsort(frequency(own), kind="stable")[:size[k] - need[k] + least[k]]])
            words.append(own)
            owner.append(np.full(len(own), k))
        words, owner = np.concatenate(words), np.concatenate(owner)
        order = np.lexsort((owner, words))
        found, starts = np.unique(words[order], return_index=True)
        return RareWords(found, np.append(starts, len(order)), owner[order], least, _stretch(size))

    def regions(self, hashes: np.ndarray, doc: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        """First word, end and item of every region with stretches that have enough rare words of the item.

        ``bounds`` has the first word of each text and the end of the last.
        """
        none = np.zeros(0, np.int64)
        if len(self.words) == 0:
            return none, none, none
        place = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        at = np.flatnonzero(self.words[place] == hashes)
        place = place[at]
        # Items in groups of bounded work: how many words of the texts are a rare one of each item.
        seen = np.bincount(place, minlength=len(self.words))
        load = np.bincount(self.items, np.repeat(seen, np.diff(self.starts)), len(self.least)).astype(np.int64)
        group = np.cumsum(load) // PAIRS_AT_A_TIME
        out = [(none, none, none)]
        for g in np.unique(group[load > 0]):
            inside = np.append(0, np.cumsum(group[self.items] == g))
            items = self.items[group[self.items] == g]
            starts = inside[self.starts]
            count = np.diff(starts)[place]
            ends = np.cumsum(count)
            total = int(ends[-1])
            own = items[np.repeat(starts[place] - (ends - count), count) + np.arange(total)]
            key = np.sort(own * len(hashes) + np.repeat(at, count))
            item, where = key // len(hashes), key % len(hashes)
            last = np.arange(total) + self.least[item] - 1
            first = np.flatnonzero(last < total)
            last = last[first]
            k = item[first]
            good = (item[last] == k) & (doc[where[last]] == doc[where[first]]) & (where[last] - where[first] < self.reach[k])
            k, a, b = k[good], where[first[good]], where[last[good]]
            if len(k) == 0:
                continue
            begin = np.maximum(b - self.reach[k] + 1, bounds[doc[a]])
            end = np.minimum(a + self.reach[k], bounds[doc[a] + 1])
            # Begins and ends both ascend within an item and text; what overlaps is one region.
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (doc[a[1:]] != doc[a[:-1]]) | (begin[1:] > end[:-1])
            head = np.flatnonzero(new)
            out.append((begin[head], end[np.append(head[1:], len(k)) - 1], k[head]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))


@dataclass
class Index:
    items: Items
    features: Features
    idf: np.ndarray
    rows: np.ndarray  # idf times basis, per feature
    vectors: np.ndarray  # items x rank, divided by the length of the item's TF-IDF vector
    item_sizes: np.ndarray  # words of each item
    item_keys: np.ndarray  # sorted hashes of (item, word), and how often the item has the word
    item_counts: np.ndarray
    energy: np.ndarray  # share of each item's TF-IDF vector that lies in the basis
    by_basis: np.ndarray  # items that are compared by cosine
    rare: RareWords  # all others

    @staticmethod
    def build(docs: DataFrame, benchmark: DataFrame) -> Index | None:
        """None if no item has a word."""
        items = Items.read(benchmark)
        if not items.ids:
            return None
        features = Features.of(items)
        # Words are found and hashed once; the counts and the turns of the fit read their features.
        coded = materialized(encoded(docs, features), "halves")
        frequency, n = _frequency(coded, features.size)
        idf = np.maximum(np.log((n + 1) / (frequency + 1)), 0) + 0.1
        found = basis(coded, items, features, idf, n)
        rows = (found * idf[:, None]).astype(np.float32)
        words = np.concatenate(items.words)
        first = np.concatenate([[0], np.cumsum([len(w) for w in items.words])[:-1]]).astype(np.int64)
        sums = np.array([rows[features(w)].sum(axis=0) for w in items.words], np.float32)
        norm = np.sqrt(np.add.reduceat(idf[features(words)] ** 2, first))
        keys = [textops.mix(w ^ textops.mix(np.full(1, k, np.uint64))) for k, w in enumerate(items.words)]
        whole = np.array([((n * idf[f]) ** 2).sum() for f, n in (np.unique(features(w), return_counts=True) for w in items.words)])
        energy = np.minimum((sums.astype(float) ** 2).sum(axis=1) / whole, 1)
        held = (energy >= CAPTURED) & (np.array([len(w) for w in items.words]) <= LONG)
        return Index(items, features, idf, rows, sums / norm[:, None].astype(np.float32),
                     np.array([len(w) for w in items.words]), *np.unique(np.concatenate(keys), return_counts=True),
                     energy, np.flatnonzero(held), RareWords.of(items, np.flatnonzero(~held), lambda w: frequency[features(w)]))

    def candidates(self, hashes: np.ndarray, doc: np.ndarray, least: float = MIN_COSINE) -> tuple[np.ndarray, ...]:
        """First word of the passage, item and cosine of every near pair, for the items that the basis holds.

        The bound falls with the share of the item that lies outside the basis.
        """
        if len(self.by_basis) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
        first, owner = halves(doc)
        feature = self.features(hashes)
        sums = _passage_vectors(_segment_sums(self.rows, feature, None, first), owner)
        square = _passage_vectors(np.add.reduceat(self.idf[feature] ** 2, first)[:, None], owner)[:, 0]
        sums /= np.sqrt(np.maximum(square, 1e-9))[:, None].astype(np.float32)
        where, item, value = [], [], []
        for a in range(0, len(self.by_basis), ITEM_BLOCK):
            own = self.by_basis[a:a + ITEM_BLOCK]
            near = sums @ self.vectors[own].T
            r, c = np.nonzero(near >= (least * self.energy[own]).astype(np.float32))
            where.append(first[r])
            item.append(own[c])
            value.append(near[r, c])
        return np.concatenate(where), np.concatenate(item), np.concatenate(value)

    def cosine(self, hashes: np.ndarray, begin: int, end: int, text: tuple[int, int], item: int) -> float:
        """The largest cosine of the item and a passage that meets ``begin:end``, without the basis."""
        start = text[0] + max(0, (begin - text[0]) // HALF - 1) * HALF
        stop = min(text[1], end + 2 * HALF)
        feature = self.features(hashes[start:stop])
        own, count = np.unique(self.features(self.items.words[item]), return_counts=True)
        place = np.minimum(np.searchsorted(own, feature), len(own) - 1)
        square = self.idf[feature] ** 2
        both = np.stack([square * np.where(own[place] == feature, count[place], 0), square])
        sums = np.add.reduceat(both, np.arange(0, stop - start, HALF), axis=1)
        sums[:, :-1] += sums[:, 1:].copy()
        length = (self.idf[self.features(self.items.words[item])] ** 2).sum()
        return float((sums[0] / np.sqrt(np.maximum(sums[1] * length, 1e-9))).max())


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence; one bit per element of ``a``."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & masks.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def shares(region: list[int], item: list[int], answer: list[int]) -> tuple[float, float]:
    """Largest share of the item's and then of the answer's words, in order, in a stretch of
    one and a half times the item's length."""
    length = int(_stretch(len(item)))
    best = (0.0, 0.0)
    for at in range(0, max(1, len(region) - length + max(1, len(item) // 4)), max(1, len(item) // 4)):
        stretch = region[at:at + length]
        share = common_subsequence(item, stretch) / len(item)
        if share > best[0]:
            best = (share, common_subsequence(answer, stretch) / len(answer))
    return best


MATCHES = "doc_id bigint, item_id bigint, cosine double, lcs_share double, answer_share double"


def _enough_words(index: Index, hashes: np.ndarray, begin: np.ndarray, end: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Whether a region has so many of the item's words at all as it must have in order."""
    out = np.zeros(len(item), bool)
    for a in range(0, len(item), 2000):
        part = slice(a, a + 2000)
        size = end[part] - begin[part]
        row = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + begin[part][row]
        key = textops.mix(hashes[at] ^ textops.mix(item[part][row].astype(np.uint64)))
        place = np.minimum(np.searchsorted(index.item_keys, key), len(index.item_keys) - 1)
        hit = index.item_keys[place] == key
        found = np.unique(row[hit] * len(index.item_keys) + place[hit])
        hits = np.bincount(found // len(index.item_keys), index.item_counts[found % len(index.item_keys)], len(size))
        out[part] = hits >= PARAPHRASE_SHARE * index.item_sizes[item[part]]
    return out


def _check(index: Index, data: np.ndarray, offsets: np.ndarray) -> list[tuple]:
    """(text, item, cosine, share, answer share) of every pair that passes the checks."""
    hashes, doc = word_hashes(data, offsets)
    if len(hashes) == 0:
        return []
    where, item, value = index.candidates(hashes, doc)
    bounds = np.searchsorted(doc, np.arange(len(offsets)))
    begins = np.maximum(where - index.item_sizes[item], bounds[doc[where]])
    ends = np.minimum(where + 2 * HALF + index.item_sizes[item], bounds[doc[where] + 1])
    able = _enough_words(index, hashes, begins, ends, item)
    rows = list(zip(*(x[able].tolist() for x in (where, item, value, begins, ends)), strict=True))
    begins, ends, item = index.rare.regions(hashes, doc, bounds)
    able = _enough_words(index, hashes, begins, ends, item)
    for begin, end, k in zip(*(x[able].tolist() for x in (begins, ends, item)), strict=True):
        text = int(bounds[doc[begin]]), int(bounds[doc[begin] + 1])
        cosine = index.cosine(hashes, begin, end, text, k)
        if cosine >= MIN_COSINE or index.item_sizes[k] > LONG:
            rows.append((begin, k, cosine, begin, end))
    out: dict[tuple[int, int], tuple] = {}
    for at, k, cosine, begin, end in sorted(rows, key=lambda x: -x[2]):
        own = int(doc[at])
        words, answer = index.items.words[k], index.items.answers[k]
        if out.get((own, k), (0.0,) * 5)[3] == 1.0:
            continue
        share, told = shares(hashes[begin:end].tolist(), words.tolist(), answer.tolist())
        known = out.get((own, k), (0.0,) * 5)
        if share > known[3] and (share >= COPY_SHARE or (share >= PARAPHRASE_SHARE and told >= ANSWER_SHARE)):
            out[own, k] = (own, index.items.ids[k], max(cosine, known[2]), share, told)
    return list(out.values())


def matches(docs: DataFrame, index: Index | None) -> DataFrame:
    """One row per document and item that it holds.

    Null and empty texts, and documents with fewer words than PARAPHRASE_SHARE of every item,
    match nothing; without items the result is empty.
    """
    rows = textops.documents(docs, "doc_id", "text")
    if index is None:
        return docs.sparkSession.createDataFrame([], MATCHES)
    shared = textops.shared(docs.sparkSession, index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.chunks(batches):
            found = _check(shared.value, *textops.utf8(batch.column("text")))
            if found:
                text, item, cosine, share, told = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(text)), pa.array(item, pa.int64()), pa.array(cosine, pa.float64()),
                     pa.array(share, pa.float64()), pa.array(told, pa.float64())],
                    [c.split()[0] for c in MATCHES.split(", ")])

    return rows.mapInArrow(run, MATCHES)


def without_items(docs: DataFrame, index: Index | None) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item."""
    if index is None:
        return docs
    shared = textops.shared(docs.sparkSession, index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.chunks(batches):
            clean = np.ones(batch.num_rows, bool)
            clean[[m[0] for m in _check(shared.value, *textops.utf8(batch.column("text")))]] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
