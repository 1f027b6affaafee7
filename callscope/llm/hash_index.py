"""A map from 64-bit hashes to small numbers that looks up whole arrays."""

from __future__ import annotations

import numpy as np


class HashIndex:
    """Open addressing over two arrays, at most half full. Unknown hashes give -1."""

    def __init__(self) -> None:
        self.n = 0
        self._room(16)

    def _room(self, bits: int) -> None:
        self.bits = bits
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, np.int32)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        keys = np.maximum(hashes, np.uint64(1))
        out = np.full(len(keys), -1, np.int32)
        place, open_ = self._place(keys), np.arange(len(keys))
        while len(open_):
            at = place[open_]
            there = self.keys[at]
            hit = there == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (there != 0)]
            place[open_] = (place[open_] + 1) & ((1 << self.bits) - 1)
        return out

    def insert(self, hashes: np.ndarray, values: np.ndarray) -> None:
        """Different hashes that are not in the index yet."""
        if self.n + len(hashes) > 1 << (self.bits - 1):
            held = self.keys != 0
            old = self.keys[held], self.values[held]
            bits = self.bits
            while self.n + len(hashes) > 1 << (bits - 1):
                bits += 1
            self._room(bits)
            self._put(*old)
        self._put(np.maximum(hashes, np.uint64(1)), values)
        self.n += len(hashes)

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        place, open_ = self._place(keys), np.arange(len(keys))
        while len(open_):
            at = place[open_]
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[open_[free]]  # of several for one place, one stays
            won = free & (self.keys[at] == keys[open_])
            self.values[at[won]] = values[open_[won]]
            open_ = open_[~won]
            place[open_] = (place[open_] + 1) & ((1 << self.bits) - 1)
