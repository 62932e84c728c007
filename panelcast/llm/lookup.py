"""A read-only hash table from 64-bit keys to row numbers, probed for whole arrays at once."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Lookup:
    """Open addressing at half load; ``find`` gives the row of each key, or -1."""

    def __init__(self, keys: np.ndarray):
        keys = np.asarray(keys).astype(np.uint64)
        bits = max(4, int(2 * max(1, len(keys)) - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.uint64)
        self.rows = np.full(1 << bits, -1, np.int32)
        left, at = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = self.rows[at] < 0
            self.rows[at[free]] = left[free]  # of several for one slot the last stays
            won = self.rows[at] == left
            self.keys[at[won]] = keys[left[won]]
            left, at = left[~won], (at[~won] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * SPREAD) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        keys = np.asarray(keys).astype(np.uint64, copy=False)
        at = self._home(keys)
        out = self.rows[at]
        again = np.flatnonzero((out >= 0) & (self.keys[at] != keys))
        at = at[again]
        while len(again):
            at = (at + 1) & self.mask
            out[again] = self.rows[at]
            go = (out[again] >= 0) & (self.keys[at] != keys[again])
            again, at = again[go], at[go]
        return out
