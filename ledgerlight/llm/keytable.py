"""A growing hash table from 64-bit keys to their places 0, 1, 2, ..., looked up for whole arrays."""

from __future__ import annotations

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)
FULLEST = 0.6


class KeyTable:
    def __init__(self, bits: int = 16):
        self.count = 0
        self.list = np.empty(1 << (bits - 1), np.int64)
        self.resize(bits)

    def resize(self, bits: int) -> None:
        self.bits, self.mask, self.shift = bits, (1 << bits) - 1, np.uint64(64 - bits)
        self.place = np.full(1 << bits, -1, np.int32)
        self.keys = np.zeros(1 << bits, np.int64)
        if self.count:
            self.settle(self.list[: self.count], np.arange(self.count))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.view(np.uint64) * MIX) >> self.shift).astype(np.int64)

    def settle(self, keys: np.ndarray, places: np.ndarray) -> None:
        slots = self.slots(keys)
        waiting = np.arange(len(keys))
        while len(waiting):
            at = slots[waiting]
            free = self.place[at] == -1
            _, winner = np.unique(at[free], return_index=True)
            chosen = waiting[free][winner]
            self.place[slots[chosen]], self.keys[slots[chosen]] = places[chosen], keys[chosen]
            left = np.ones(len(waiting), bool)
            left[np.flatnonzero(free)[winner]] = False
            waiting = waiting[left]
            slots[waiting] = (slots[waiting] + 1) & self.mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 if it isn't held."""
        slots = self.slots(keys)
        out = self.place[slots]
        wrong = np.flatnonzero((self.keys[slots] != keys) & (out >= 0))
        while len(wrong):
            slots[wrong] = (slots[wrong] + 1) & self.mask
            at = slots[wrong]
            out[wrong] = self.place[at]
            wrong = wrong[(self.keys[at] != keys[wrong]) & (out[wrong] >= 0)]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Take in distinct keys that aren't held."""
        total = self.count + len(keys)
        if total > len(self.list):
            wider = np.empty(max(total, len(self.list) + len(self.list) // 2), np.int64)
            wider[: self.count] = self.list[: self.count]
            self.list = wider
        self.list[self.count:total] = keys
        places = np.arange(self.count, total)
        self.count = total
        if total > FULLEST * (self.mask + 1):
            self.resize(int(total / FULLEST).bit_length())
        else:
            self.settle(keys, places)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key; new ones are taken in."""
        out = self.find(keys)
        new = out < 0
        if new.any():
            self.add(np.unique(keys[new]))
            out[new] = self.find(keys[new])
        return out

    def held(self) -> np.ndarray:
        return self.list[: self.count]
