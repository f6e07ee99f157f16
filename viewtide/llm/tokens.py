"""Token ids of texts, by the ``tokenizers`` library, each distinct piece encoded once.

A byte-level BPE first cuts a text into pieces (words with the space before them, numbers,
punctuation, white space) and never merges across them. Pieces repeat far more than texts
do, so the cuts are found for many texts at once and the library is asked only for pieces
not seen before in this worker. Texts with characters whose class differs between versions
of Unicode and texts that hold an added token of the vocabulary (``<|endoftext|>``) go to the
library whole. The ids are those of encoding each text by itself.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Sequence
from itertools import chain

import numpy as np

from viewtide.llm.kernels import CodeHash, gather

SPACE, BLANK, LETTER, NUMBER, OTHER, END, UNSURE = range(7)
TABLE_BITS = 20  # pieces remembered from call to call, in slots twice as many
CACHED_IDS = 8_000_000
JOINED = 256


def _classes() -> np.ndarray:
    """Class of each code point of the basic plane; one entry more stands for the rest."""
    table = np.full(0x10001, UNSURE, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER, "Z": BLANK}
    old = unicodedata.ucd_3_2_0
    for point in range(0x10000):
        char = chr(point)
        kind = unicodedata.category(char)
        if kind == old.category(char) and kind not in ("Cn", "Cs", "Co", "Cf"):
            table[point] = kinds.get(kind[0], OTHER)
    table[0x09:0x0E] = BLANK
    table[0x1C:0x20] = table[0x85] = UNSURE
    table[0x20] = SPACE
    return table


_table: np.ndarray | None = None


def piece_starts(codes: np.ndarray, ends: np.ndarray, whole: Sequence[int] = ()) -> np.ndarray:
    """Where the pieces of the texts start; ``ends`` are the places after each text, which
    become pieces of their own. The texts numbered in ``whole`` are one piece each."""
    global _table
    if _table is None:
        _table = _classes()
    kind = _table[np.minimum(codes, 0x10000)]
    kind[ends] = END
    blank = kind <= BLANK
    before = np.empty_like(kind)
    before[0], before[1:] = END, kind[:-1]
    after = np.empty_like(kind)
    after[-1], after[:-1] = END, kind[1:]
    blank_before = before <= BLANK
    # A run of letters, digits or others starts a piece, or the one space before it does.
    starts = ~blank & (kind != before) & (before != SPACE)
    # Of white space before something else, the last character stands apart.
    starts |= blank & ~blank_before
    starts |= blank & blank_before & (after > BLANK) & (after != END)
    # 's 't 're 've 'm 'll 'd, where an apostrophe starts a piece.
    quote = np.flatnonzero((codes[:-2] == 39) & (kind[1:-1] == LETTER) & starts[:-2])
    if len(quote):
        one, two = codes[quote + 1], codes[quote + 2]
        short = np.isin(one, [115, 116, 109, 100])
        long = ((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108))
        for hit, width in ((short, 2), (long & ~short, 3)):
            at = quote[hit]
            starts[at + 1] = False
            rest = at + width
            starts[rest[kind[rest] == LETTER]] = True
    unsure = np.unique(np.searchsorted(ends, np.flatnonzero(kind == UNSURE)))
    if len(unsure) or len(whole):
        first = np.concatenate([[0], ends[:-1] + 1])
        for i in {*unsure.tolist(), *whole}:
            starts[first[i] : ends[i]] = False
            starts[first[i]] = True
    starts[ends] = True
    return np.flatnonzero(starts)


class PieceTable:
    """Numbers of known pieces by their 64-bit hash: an open hash table in two arrays, so
    that millions of pieces are looked up in a few array operations. It doubles before more
    than half of its slots are taken, as one long text may have any number of pieces."""

    def __init__(self) -> None:
        self._empty(TABLE_BITS)

    def _empty(self, bits: int) -> None:
        self.bits, self.used = bits, 0
        self.keys = np.zeros(2 << bits, np.uint64)
        self.numbers = np.zeros(2 << bits, np.int32)

    def _slots(self, hashes: np.ndarray, probe: int) -> np.ndarray:
        start = (hashes >> np.uint64(63 - self.bits)).astype(np.int64)
        return (start + probe) & ((2 << self.bits) - 1)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each, -1 if it is not known."""
        found = np.full(len(hashes), -1, np.int64)
        slot = self._slots(hashes, 0)
        key = self.keys[slot]
        hit = key == hashes
        found[hit] = self.numbers[slot[hit]]
        left, probe = np.flatnonzero(~hit & (key != 0)), 0
        while len(left):
            probe += 1
            slot = self._slots(hashes[left], probe)
            key = self.keys[slot]
            hit = key == hashes[left]
            found[left[hit]] = self.numbers[slot[hit]]
            left = left[~hit & (key != 0)]
        return found

    def add(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        """Distinct new hashes."""
        if self.used + len(hashes) > 1 << self.bits:
            taken = np.flatnonzero(self.keys)
            keys, known = self.keys[taken], self.numbers[taken]
            self._empty((self.used + len(hashes) - 1).bit_length())
            self.add(keys, known)
        self.used += len(hashes)
        left, probe = np.arange(len(hashes)), 0
        while len(left):
            slot = self._slots(hashes[left], probe)
            free = self.keys[slot] == 0
            self.keys[slot[free]] = hashes[left[free]]
            own = self.keys[slot] == hashes[left]  # two may have wanted one slot
            self.numbers[slot[own]] = numbers[left[own]]
            left, probe = left[~own], probe + 1


class Encoder:
    """Encodes many texts at once; ``end`` is appended to each."""

    def __init__(self, path: str, end: int = 0) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Looked for in every text; an empty class matches nowhere.
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))) or r"[^\s\S]")
        self.end = end
        self.reset()

    def reset(self) -> None:
        self.known = PieceTable()
        self.flat = np.array([self.end], np.uint32)
        self.first, self.count = np.array([0], np.int32), np.array([1], np.int32)

    def learn(self, pieces: list[str], hashes: np.ndarray) -> None:
        # Pieces that begin with a space stay apart when they stand in one text, and the
        # library says which piece an id is of; that costs it half of many short texts.
        spaced = [
            i for i, p in enumerate(pieces)
            if len(p) > 1 and p[0] == " " and not p[1].isspace() and not self.added.search(p)
        ]
        groups = [spaced[i : i + JOINED] for i in range(0, len(spaced), JOINED)]
        alone = sorted(set(range(len(pieces))) - set(spaced))
        order, ids, counts = [], [], []
        made = self.tokenizer.encode_batch(
            ["".join([pieces[i] for i in g]) for g in groups], add_special_tokens=False
        )
        for group, encoding in zip(groups, made):
            words = np.array(encoding.word_ids, np.int64)
            if words[-1] + 1 != len(group):
                alone += group
                continue
            order += group
            ids.append(encoding.ids)
            counts.append(np.bincount(words, minlength=len(group)))
        single = [
            e.ids for e in self.tokenizer.encode_batch_fast(
                [pieces[i] for i in alone], add_special_tokens=False
            )
        ]
        order += alone
        counts = np.concatenate([*counts, np.array([len(x) for x in single], np.int64)])
        new = np.fromiter(chain.from_iterable([*ids, *single]), np.uint32, int(counts.sum()))
        at = len(self.flat) + np.cumsum(counts) - counts
        self.known.add(hashes[order], np.arange(len(self.first), len(self.first) + len(order)))
        self.flat = np.concatenate([self.flat, new])
        self.first = np.concatenate([self.first, at.astype(np.int32)])
        self.count = np.concatenate([self.count, counts.astype(np.int32)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has (with its end)."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        joined = "\n".join(texts) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        whole = [i for i, t in enumerate(texts) if self.added.search(t)]
        starts = piece_starts(codes, ends, whole)
        stops = np.append(starts[1:], len(codes))
        hashes = np.maximum(CodeHash(codes).of(starts, stops), np.uint64(1))
        if len(self.first) + len(starts) > 1 << TABLE_BITS or len(self.flat) > CACHED_IDS:
            self.reset()
        entry = self.known.find(hashes)
        last = np.searchsorted(starts, ends)
        entry[last] = 0
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            which = missing[first]
            self.learn([joined[a:b] for a, b in zip(starts[which].tolist(), stops[which].tolist())], new)
            entry[missing] = self.known.find(hashes[missing])
        counts = self.count[entry].astype(np.int64)
        ids = self.flat[gather(self.first[entry], counts)]
        total = np.cumsum(counts)[last]
        return ids, np.diff(total, prepend=0)


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end: int = 0) -> Encoder:
    """One per worker process, so that what it has seen serves its later tasks."""
    if (path, end) not in _encoders:
        _encoders[path, end] = Encoder(path, end)
    return _encoders[path, end]
