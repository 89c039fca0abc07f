"""Token ids of whole texts with a public tokenizer file.

The library splits a text into pre-tokens and merges inside each one only, so the
ids of a text are the ids of its parts in a row, as long as parts end where
pre-tokens end.  Texts of Latin letters are cut into such parts with numpy; each
different part goes through the library once per worker and is kept in a table of
bounded size.  Any other text goes through the library as a whole, and so does one
that holds the content of an added token, which the library finds before it splits.
"""

from __future__ import annotations

import functools
import os

import numpy as np

from fundtide.llm import textops

#: Parts kept per generation of a worker's table; longer parts are not kept.
ENTRIES, ENTRY_BYTES = 500_000, 64
#: Bytes of text taken at a time: more give fewer different parts per byte.
CHUNK_BYTES = 3 << 20

_SPACE, _LETTER, _NUMBER, _OTHER, _FOREIGN = range(5)


def _byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """Class of each single byte, and of a character that begins with C2, by its second byte."""
    one = np.full(256, _FOREIGN, np.uint8)
    one[0x21:0x7F] = _OTHER
    one[list(b"\t\n\r ")] = _SPACE
    one[ord("0"):ord("9") + 1] = _NUMBER
    one[ord("A"):ord("Z") + 1] = one[ord("a"):ord("z") + 1] = _LETTER
    one[0x80:0xC0] = one[0xC2:0xC9] = _LETTER  # U+00C0 .. U+023F; C2 is settled by what follows
    two = np.full(256, _OTHER, np.uint8)
    two[0x80:0xA0] = _FOREIGN
    two[0xA0] = _SPACE
    two[[0xAA, 0xB5, 0xBA]] = _LETTER
    two[[0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = _NUMBER
    return one, two


_ONE, _AFTER_C2 = _byte_classes()
_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[ord("A"):ord("Z") + 1] += 32


def _classes(data: np.ndarray) -> np.ndarray:
    kinds = _ONE[data]
    at = np.flatnonzero(data[:-1] == 0xC2)
    kinds[at] = kinds[at + 1] = _AFTER_C2[data[at + 1]]
    at = np.flatnonzero(data[:-1] == 0xC3)  # the signs of multiplication and division
    at = at[(data[at + 1] == 0x97) | (data[at + 1] == 0xB7)]
    kinds[at] = kinds[at + 1] = _OTHER
    at = np.flatnonzero(data[:-1] == 0xC4)  # a capital whose lower case is longer
    kinds[at[data[at + 1] == 0xB0]] = _FOREIGN
    return kinds


class _Table(dict):
    """Hash of a part to its ids, in two generations; what is still in use moves to the new one."""

    def __init__(self):
        super().__init__()
        self._old: dict[int, bytes] = {}

    def old(self, key: int) -> bytes | None:
        if (found := self._old.get(key)) is not None:
            self.add(key, found)
        return found

    def add(self, key: int, ids: bytes) -> None:
        if len(self) >= ENTRIES:
            self._old = dict(self)
            self.clear()
        self[key] = ids


class Encoder:
    """Ids of batches of texts with the tokenizer file at ``path``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        normal, split = str(self._tokenizer.normalizer), str(self._tokenizer.pre_tokenizer)
        #: White space ends pre-tokens and has no ids itself, and capitals do not matter.
        self._drops_space = "Lowercase" in normal and "Split(" in split and "Removed" in split
        self._byte_level = self._tokenizer.normalizer is None and "Split(" not in split and "use_regex=True" in split
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._added = [t.content.encode() for t in added if t.content]
        if any(t.normalized for t in added):  # these are found in the normalised text
            self._drops_space = self._byte_level = False
        self._table = _Table()

    def whole(self, text: str) -> np.ndarray:
        """By the library alone."""
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _cuts(self, kinds: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether a part begins at each byte."""
        begins = np.ones(len(kinds), bool)
        change = kinds[1:] != kinds[:-1]
        if self._drops_space:
            begins[1:] = change
        else:
            # Of a run of white space all but the last character are one pre-token; the last
            # one belongs to what follows if it is a plain space, and else stands alone.
            spaces = kinds == _SPACE
            before = spaces[:-1]
            begins[1:] = change & ~(before & (data[:-1] == 0x20))
            heads = spaces & ((data & 0xC0) != 0x80)  # first byte of each white-space character
            last = np.flatnonzero(heads[:-1])
            follow = last + np.where(data[last] == 0xC2, 2, 1)
            last = last[(follow < len(kinds)) & ~spaces[np.minimum(follow, len(kinds) - 1)]]
            begins[last] = True
            # Not where the text ends: there the whole run is one pre-token.
            ends = textops.first_ends(offsets)
            ends = ends[ends < len(kinds)]
            undo = np.where(data[ends - 1] == 0xA0, ends - 2, ends - 1)
            undo = undo[spaces[undo]]
            begins[undo] = change[np.maximum(undo - 1, 0)]
        # "'s" and the like reach into the letters; keep them together.
        quote = np.flatnonzero(data[:-1] == 0x27)
        begins[quote[kinds[quote + 1] == _LETTER] + 1] = False
        begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        return begins

    def _with_added(self, raw: bytes, offsets: np.ndarray) -> np.ndarray:
        """Texts that hold the content of an added token."""
        found = []
        for content in self._added:
            at = raw.find(content)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, side="right")) - 1
                if at + len(content) <= offsets[text + 1]:
                    found.append(text)
                    at = raw.find(content, int(offsets[text + 1]))
                else:
                    at = raw.find(content, at + 1)
        return np.unique(np.array(found, np.int64))

    def parts(self, data: np.ndarray, offsets: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the parts of all texts; the texts ``whole`` are one part each."""
        kinds = _classes(data)
        full = np.flatnonzero(offsets[:-1] < offsets[1:])
        if self._drops_space or self._byte_level:
            starts = np.flatnonzero(self._cuts(kinds, data, offsets))
            foreign = np.unique(np.searchsorted(offsets, np.flatnonzero(kinds == _FOREIGN), side="right") - 1)
            foreign = np.union1d(foreign, whole)
        else:
            starts, foreign = offsets[:-1][full], full
        ends = np.append(starts[1:], len(data))
        if len(foreign):
            inside = np.isin(np.searchsorted(offsets, starts, side="right") - 1, foreign)
            starts = np.sort(np.concatenate([starts[~inside], offsets[:-1][foreign]]))
            ends = np.append(starts[1:], len(data))
        if self._drops_space:
            keep = (kinds[starts] != _SPACE) | np.isin(starts, offsets[:-1][foreign])
            starts, ends = starts[keep], ends[keep]
        return starts, ends

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin (n + 1 offsets)."""
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        raw = data.tobytes()
        added = self._with_added(raw, offsets)
        starts, ends = self.parts(data, offsets, added)
        plain = _ASCII_LOWER[data] if self._drops_space else data
        keys = textops.Rolling(plain).ranges(starts, ends)
        if len(added):  # capitals matter to added tokens
            own = np.isin(starts, offsets[:-1][added])
            keys[own] = textops.mix(~textops.Rolling(data).ranges(starts[own], ends[own]))
        keys, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        numbers = keys.tolist()
        found = list(map(self._table.get, numbers))
        for i in [i for i, ids in enumerate(found) if ids is None]:
            found[i] = self._table.old(numbers[i])
        new = [i for i, ids in enumerate(found) if ids is None]
        texts = [raw[starts[first[i]]:ends[first[i]]] for i in new]
        for i, text, encoding in zip(new, texts, self._tokenizer.encode_batch(
                [t.decode() for t in texts], add_special_tokens=False), strict=True):
            found[i] = np.array(encoding.ids, "<u4").tobytes()
            if len(text) <= ENTRY_BYTES:
                self._table.add(numbers[i], found[i])
        counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        at = np.cumsum(counts) - counts
        each = counts[inverse]
        ends_out = np.cumsum(each)
        ids = flat[np.repeat(at[inverse] - (ends_out - each), each) + np.arange(ends_out[-1] if len(each) else 0)]
        placed = np.concatenate([[0], ends_out])
        return ids, placed[np.searchsorted(starts, offsets)]


@functools.lru_cache(maxsize=4)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


#: Tasks that may use what an earlier one has left.
KIND = "tokenizer"


def encoder(path: str) -> Encoder:
    """One encoder per worker and file, until tasks of other operators need the memory."""
    textops.keep(KIND, _encoder.cache_clear)
    return _encoder(path)
