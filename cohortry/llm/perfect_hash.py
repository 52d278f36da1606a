"""A minimal perfect hash of distinct 64-bit keys in numpy arrays."""

from __future__ import annotations

import numpy as np

from cohortry.llm.words import mix

_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Places of a level for each of its keys.
SPARE = 2


class PerfectHash:
    """Levels of bits: a key has the number of set bits before its own, in the first level where it met no other key.

    ``keys`` holds the key of every number, so a lookup of a foreign key gives -1 and not the number of another.
    """

    def __init__(self, levels: list[np.ndarray], keys: np.ndarray):
        self.levels, self.keys = levels, keys
        counts = [int(x.sum()) for x in levels]
        self.ranks = [np.cumsum(x) - x + sum(counts[:k]) for k, x in enumerate(levels)]

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys ^ mix(np.array([level + 1], np.uint64) * _STEP)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """The hash of distinct keys; keys that meet at a level try the next one, with another seed."""
        left, levels, ordered = np.unique(keys.astype(np.uint64)), [], []
        while len(left):
            size = SPARE * len(left)
            at = cls._places(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            placed = alone[at]
            ordered.append(left[placed][np.argsort(at[placed])])
            left = left[~placed]
        return cls(levels, np.concatenate([np.zeros(0, np.uint64), *ordered]))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of every key, -1 where it is none of the keys."""
        keys = keys.astype(np.uint64)
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for k, level in enumerate(self.levels):
            at = self._places(keys[left], k, len(level))
            hit = level[at]
            out[left[hit]] = self.ranks[k][at[hit]]
            left = left[~hit]
        known = out >= 0
        known[known] = self.keys[out[known]] == keys[known]
        return np.where(known, out, -1)

    def dump(self) -> tuple[list[int], bytes, bytes]:
        """Sizes of the levels, their bits, and the keys."""
        return [len(x) for x in self.levels], b"".join(np.packbits(x).tobytes() for x in self.levels), self.keys.astype("<u8").tobytes()

    @classmethod
    def load(cls, sizes: list[int], bits: bytes, keys: bytes) -> PerfectHash:
        levels, at = [], 0
        for size in sizes:
            n = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(bits, np.uint8, n, at), count=size).astype(bool))
            at += n
        return cls(levels, np.frombuffer(keys, "<u8").astype(np.uint64))
