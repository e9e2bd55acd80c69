"""A fixed hash table over 64-bit keys that is asked for many keys at once."""

from __future__ import annotations

import numpy as np

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.int64(-1)


class Places:
    """Place of a key in the array it was made from, by linear probing in a table that is at most half full.

    Keys are distinct and not negative. It takes 12 bytes a slot, at most four slots a key.
    """

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, _EMPTY, np.int64)
        self.places = np.full(1 << bits, -1, np.int32)
        left = np.arange(len(keys))
        slots = self._slots(keys)
        while len(left):
            free = self.keys[slots] == _EMPTY
            slot, first = np.unique(slots[free], return_index=True)  # one new key a slot and round
            won = left[free][first]
            self.keys[slot], self.places[slot] = keys[won], won
            lost = self.keys[slots] != keys[left]
            left, slots = left[lost], (slots[lost] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _FACTOR) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys, -1 for keys that are not there."""
        slots = self._slots(keys)
        seen = self.keys[slots]
        out = np.where(seen == keys, self.places[slots], -1)
        left = np.flatnonzero((seen != keys) & (seen != _EMPTY))
        while len(left):
            slots = (slots if len(slots) == len(left) else slots[left]) + 1 & self.mask
            seen = self.keys[slots]
            hit = seen == keys[left]
            out[left[hit]] = self.places[slots[hit]]
            go = ~hit & (seen != _EMPTY)
            left, slots = left[go], slots[go]
        return out
