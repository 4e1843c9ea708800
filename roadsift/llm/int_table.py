"""A hash table over numpy arrays: many keys are looked up in a few vector steps."""

from __future__ import annotations

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)


class IntTable:
    """Distinct non-negative int64 keys to int64 values; open addressing, half full at most."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        place, left = self._place(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[place[left]] < 0]
            _, one = np.unique(place[free], return_index=True)
            won = free[one]
            self.keys[place[won]], self.values[place[won]] = keys[won], values[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            place[left] = np.where(self.keys[place[left]] >= 0, (place[left] + 1) & self.mask, place[left])

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray, default: int = -1) -> np.ndarray:
        out, place = np.full(len(keys), default, np.int64), self._place(keys)
        seen = self.keys[place]
        hit = seen == keys
        out[hit] = self.values[place[hit]]
        left = np.flatnonzero(~hit & (seen >= 0))
        while len(left):
            place[left] = (place[left] + 1) & self.mask
            seen = self.keys[place[left]]
            hit = seen == keys[left]
            out[left[hit]] = self.values[place[left[hit]]]
            left = left[~hit & (seen >= 0)]
        return out
