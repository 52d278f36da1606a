"""Vectorised word and shingle hashes of Arrow text columns.

A word is ``[^\\x20\\x09-\\x0D]+`` over the UTF-8 bytes, with A-Z lower-cased. Texts are worked on in runs
of about a megabyte, so that the arrays of a run stay in the processor's caches and memory does not
depend on the size of an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_ODD = np.uint64(0xD6E8FEB86659FD93)
#: Words of more bytes are hashed one by one, shorter ones all at once.
LONG_WORD = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_runs(column: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows with about ``limit`` bytes; null counts as empty."""
    if not len(column):
        return
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + limit, "right")) - 1)
        yield row, whole[ends[row] : ends[stop]], ends[row : stop + 1] - ends[row]
        row = stop


def word_spans(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word of a run, and for each text the number of its first word."""
    solid = ~_BLANK[text]
    edge = np.zeros(len(text) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(text), bool)
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.zeros(len(text), bool)
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def eights(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every byte on as one number (with zeros beyond the end), as a view of a padded copy."""
    padded = np.zeros(len(text) + 8, np.uint8)
    padded[: len(text)] = text
    return np.ndarray((len(text) + 1,), "<u8", padded, strides=(1,))


def lowered(text: np.ndarray) -> np.ndarray:
    return _LOWER[text]


def word_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every word: the sum of its scrambled pieces of eight bytes, each with its place, scrambled with its length.

    Scrambling is not linear, so words that repeat a pattern are told apart like any others.
    """
    return hash_eights(eights(lowered(text) if lower else text), starts, ends - starts, seed)


def hash_eights(view: np.ndarray, starts: np.ndarray, sizes: np.ndarray, seed: int = 0) -> np.ndarray:
    """``word_hashes`` on what ``eights`` returns."""
    salts = mix(np.arange(1, -(-LONG_WORD // 8) + 1, dtype=np.uint64) * _ODD + np.uint64(seed))
    total = mix((view[starts] & _KEEP[np.minimum(sizes, 8)]) ^ salts[0])
    live = np.flatnonzero(sizes > 8)
    for k in live[sizes[live] > LONG_WORD].tolist():
        n = -(-int(sizes[k]) // 8)
        value = view[int(starts[k]) : int(starts[k]) + 8 * n - 7 : 8] & np.uint64(0xFFFFFFFFFFFFFFFF)
        value[-1] &= _KEEP[int(sizes[k]) - 8 * (n - 1)]
        total[k] = mix(value ^ mix(np.arange(1, n + 1, dtype=np.uint64) * _ODD + np.uint64(seed))).sum(dtype=np.uint64)
    live = live[sizes[live] <= LONG_WORD]
    at = 8
    while len(live):
        left = sizes[live] - at
        total[live] += mix((view[starts[live] + at] & _KEEP[np.minimum(left, 8)]) ^ salts[at // 8])
        live = live[left > 8]
        at += 8
    return mix(total + sizes.astype(np.uint64) * _ODD)


def same_bytes(view: np.ndarray, starts: np.ndarray, other: np.ndarray, other_starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether each word has the same bytes as its counterpart of the same size; both sides as ``eights`` returns them."""
    same = (view[starts] ^ other[other_starts]) & _KEEP[np.minimum(sizes, 8)] == 0
    live = np.flatnonzero(sizes > 8)
    for k in live[sizes[live] > LONG_WORD].tolist():
        a, b, n = int(starts[k]), int(other_starts[k]), int(sizes[k])
        same[k] = (view[a : a + n - 7 : 8] == other[b : b + n - 7 : 8]).all() and view[a + n - 8] == other[b + n - 8]
    live = live[sizes[live] <= LONG_WORD]
    at = 8
    while len(live):
        left = sizes[live] - at
        same[live] &= (view[starts[live] + at] ^ other[other_starts[live] + at]) & _KEEP[np.minimum(left, 8)] == 0
        live = live[left > 8]
        at += 8
    return same


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive words at every position that has them, without regard to text ends."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    count = len(words) - n + 1
    out = words[:count]
    for k in range(1, n):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + count])
    return out


def sequence_hash(words: np.ndarray) -> int:
    """The hash of a whole sequence that is shorter than a shingle; its length is part of it."""
    value = np.array([len(words)], np.uint64)
    for k in range(len(words)):
        value = mix(value * np.uint64(0xD6E8FEB86659FD93) + words[k : k + 1])
    return int(value[0])


def shingle_sets(column: pa.Array, n: int, whole_if_short: bool, seed: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text of an Arrow column."""
    for first, text, offsets in text_runs(column):
        starts, ends, heads = word_spans(text, offsets)
        words = word_hashes(text, starts, ends, seed=seed)
        grams = shingle_hashes(words, n)
        for k in range(len(offsets) - 1):
            a, b = int(heads[k]), int(heads[k + 1])
            if b - a >= n:
                yield first + k, np.unique(grams[a : b - n + 1])
            elif b > a and whole_if_short:
                yield first + k, np.array([sequence_hash(words[a:b])], np.uint64)
            else:
                yield first + k, np.zeros(0, np.uint64)


class HashIndex:
    """Places of 64-bit hashes, in an open table of arrays."""

    def __init__(self, bits: int = 16):
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, np.int32)
        self.count = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of every hash, -1 where there is none."""
        mask = np.uint64(len(self.keys) - 1)
        hashes = np.maximum(hashes, np.uint64(1))
        out = np.full(len(hashes), -1, np.int32)
        at = hashes & mask
        left = np.arange(len(hashes))
        while len(left):
            there = self.keys[at]
            hit = there == hashes[left]
            out[left[hit]] = self.values[at[hit]]
            go = ~hit & (there != 0)
            left, at = left[go], (at[go] + np.uint64(1)) & mask
        return out

    def add(self, hashes: np.ndarray, places: np.ndarray) -> None:
        """Add distinct hashes that are not there yet."""
        hashes = np.maximum(hashes, np.uint64(1))
        self.count += len(hashes)
        while 2 * self.count > len(self.keys):
            old_keys, old_values = self.keys, self.values
            self.keys, self.values = np.zeros(2 * len(old_keys), np.uint64), np.zeros(2 * len(old_keys), np.int32)
            full = old_keys != 0
            self._put(old_keys[full], old_values[full])
        self._put(hashes, places.astype(np.int32))

    def _put(self, hashes: np.ndarray, places: np.ndarray) -> None:
        mask = np.uint64(len(self.keys) - 1)
        at = hashes & mask
        while len(hashes):
            free = self.keys[at] == 0
            self.keys[at[free]] = hashes[free]
            won = self.keys[at] == hashes
            self.values[at[won]] = places[won]
            hashes, places, at = hashes[~won], places[~won], (at[~won] + np.uint64(1)) & mask


class WordTable:
    """Words that were met before, with their bytes. A word is found by its hash, and its bytes are then compared."""

    def __init__(self):
        self.index = HashIndex()
        self.bytes = np.zeros(1 << 18, np.uint8)
        self.ends = np.zeros(1 << 14, np.int32)

    def __len__(self) -> int:
        return self.index.count

    @property
    def size(self) -> int:
        return int(self.ends[len(self)])

    def places(self, view: np.ndarray, starts: np.ndarray, sizes: np.ndarray, learn: Callable[[list[bytes]], None]) -> np.ndarray | None:
        """The number of every word, in the order in which words were first met; none where two words share a hash.

        ``view`` is what ``eights`` returns. ``learn`` gets the bytes of the new words, before they are numbered.
        """
        hashes = hash_eights(view, starts, sizes)
        found = self.index.find(hashes)
        new = np.flatnonzero(found < 0)
        if len(new):
            _, first = np.unique(hashes[new], return_index=True)
            first = new[first]
            text = view.base
            words = [text[a : a + n].tobytes() for a, n in zip(starts[first].tolist(), sizes[first].tolist(), strict=True)]
            learn(words)
            self._add(hashes[first], words)
            found[new] = self.index.find(hashes[new])
        low = self.ends[found]
        own = np.ndarray((len(self.bytes) - 7,), "<u8", self.bytes, strides=(1,))
        if (self.ends[found + 1] - low != sizes).any() or not same_bytes(view, starts, own, low, sizes).all():
            return None
        return found

    def _add(self, hashes: np.ndarray, words: list[bytes]) -> None:
        at, new = len(self), len(words)
        ends = self.ends[at] + np.cumsum([len(w) for w in words])
        while at + new >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while ends[-1] + 8 > len(self.bytes):
            self.bytes = np.concatenate([self.bytes, np.zeros_like(self.bytes)])
        self.bytes[self.ends[at] : ends[-1]] = np.frombuffer(b"".join(words), np.uint8)
        self.ends[at + 1 : at + 1 + new] = ends
        self.index.add(hashes, np.arange(at, at + new))
