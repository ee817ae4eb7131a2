"""Minimal perfect hash of a set of 64-bit keys as levels of bitmaps (numpy).

Level k maps the keys left over to ``SPACE_FACTOR`` places each; a place met by exactly one key sets
its bit, the other keys go on to the next level.  A key's index is the rank of its bit over all
levels, so the indexes of n keys are 0..n-1.
"""

from __future__ import annotations

import numpy as np

from ratewise.llm.common import mix

SPACE_FACTOR = 2.0
MAX_LEVELS = 64


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    def __init__(self, levels: list[np.ndarray]):
        """levels: packed bitmaps, the last byte of padding included."""
        self.sizes = [len(b) * 8 for b in levels]
        self.bits = [np.unpackbits(b, bitorder="little").astype(bool) for b in levels]
        self.ranks, total = [], 0
        for b in self.bits:
            self.ranks.append(total + np.cumsum(b) - b)
            total += int(b.sum())
        self.n = total

    @classmethod
    def build(cls, keys: np.ndarray) -> tuple[PerfectHash, list[bytes]]:
        """From distinct uint64 keys."""
        levels, left = [], keys
        for level in range(MAX_LEVELS):
            if not len(left):
                break
            size = 8 * max(1, int(np.ceil(SPACE_FACTOR * len(left) / 8)))
            place = _place(left, level, size)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[place]]
        if len(left):
            raise ValueError("keys of a perfect hash must be distinct")
        return cls(levels), [b.tobytes() for b in levels]

    @classmethod
    def load(cls, blobs: list[bytes]) -> PerfectHash:
        return cls([np.frombuffer(b, np.uint8) for b in blobs])

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; a key outside the set gets any index, or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (size, bits, rank) in enumerate(zip(self.sizes, self.bits, self.ranks)):
            if not len(left):
                break
            place = _place(keys[left], level, size)
            hit = bits[place]
            out[left[hit]] = rank[place[hit]]
            left = left[~hit]
        return out
