"""Integer keys to places in numpy arrays, looked up many at a time."""

from __future__ import annotations

import numpy as np


class HashMap:
    """Keys, 64-bit integers but -1, to 32-bit places, by open addressing; ``room`` is
    for how many keys the map has slots, those in ``keys`` at least."""

    def __init__(self, keys: np.ndarray, room: int = 0) -> None:
        self.bits = max(4, int(2 * max(len(keys), room) + 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        self.insert(keys, np.arange(len(keys), dtype=np.int32))

    def insert(self, keys: np.ndarray, value: np.ndarray) -> None:
        """Add distinct ``keys`` that the map does not hold."""
        left, at = keys, self.slot(keys)
        while len(left):
            free = self.keys[at] == -1
            self.keys[at[free]] = left[free]  # of several for one slot the last one stays
            stays = self.keys[at] == left
            self.values[at[stays]] = value[stays]
            left, value, at = left[~stays], value[~stays], (at[~stays] + 1) & ((1 << self.bits) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for those not held."""
        at = self.slot(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], -1)
        open_ = np.flatnonzero((held != keys) & (held != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return out
