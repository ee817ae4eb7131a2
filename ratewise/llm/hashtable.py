"""A hash table over numpy arrays."""

from __future__ import annotations

import numpy as np

_MULT = np.uint64(0x9E3779B97F4A7C15)


class HashTable:
    """Open-addressed hash table from distinct 64-bit keys to rows of a float matrix."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.rows = np.zeros(1 << self.bits, dtype=np.int32)
        self.values = values.astype(np.float32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] == np.uint64(0xFFFFFFFFFFFFFFFF)
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            put = np.zeros(len(left), dtype=bool)
            put[first] = True
            put &= free
            self.keys[slot[put]], self.rows[slot[put]] = keys[left[put]], left[put]
            left, slot = left[~put], (slot[~put] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MULT) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it's absent."""
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.rows[slot], -1)
        left = np.flatnonzero((there != keys) & (there != np.uint64(0xFFFFFFFFFFFFFFFF)))
        while len(left):
            slot_left = (slot[left] + 1) & self.mask
            slot[left] = slot_left
            there = self.keys[slot_left]
            hit = there == keys[left]
            out[left[hit]] = self.rows[slot_left[hit]]
            left = left[~hit & (there != np.uint64(0xFFFFFFFFFFFFFFFF))]
        return out
