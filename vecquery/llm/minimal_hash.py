"""Minimal perfect hash functions over sets of 64-bit keys, in NumPy.

Every level is a bit array of about ``GAMMA`` bits per key that is still open. A key whose place no other key shares
sets its bit and is done; the others go on to the next level. A key's number is the count of bits set before its own, so
n keys get the numbers 0 to n - 1. The few keys still open after ``MOST_LEVELS`` are kept sorted and numbered last.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

GAMMA = 2.0
MOST_LEVELS = 24


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """A different well-mixed 64-bit number of each key for every level."""
    x = keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    return ((_mixed(keys, level) >> np.uint64(32)) * np.uint64(bits) >> np.uint64(32)).astype(np.int64)


@dataclass(frozen=True)
class PerfectHash:
    """Numbers of a fixed key set; other keys get some number or -1, which a fingerprint has to tell."""

    levels: list[np.ndarray]
    rest: np.ndarray

    def __post_init__(self):
        before, ranks = 0, []
        for words in self.levels:
            ends = np.cumsum(np.bitwise_count(words), dtype=np.int64)
            ranks.append(np.concatenate([[0], ends[:-1]]) + before)
            before += int(ends[-1])
        object.__setattr__(self, "_ranks", ranks)
        object.__setattr__(self, "_first_rest", before)

    @staticmethod
    def build(keys: np.ndarray) -> PerfectHash:
        """``keys``: distinct unsigned 64-bit numbers."""
        levels, left = [], keys
        while len(left) and len(levels) < MOST_LEVELS:
            bits = 64 * max(1, int(np.ceil(GAMMA * len(left) / 64)))
            place = _places(left, len(levels), bits)
            alone = np.bincount(place, minlength=bits)[place] == 1
            marked = np.zeros(bits, dtype=bool)
            marked[place[alone]] = True
            levels.append(np.packbits(marked, bitorder="little").view(np.uint64))
            left = left[~alone]
        return PerfectHash(levels, np.sort(left))

    def index(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int64)
        at = np.arange(len(keys))
        for level, words in enumerate(self.levels):
            if not len(at):
                return out
            place = _places(keys[at], level, 64 * len(words))
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            hit = (words[word] >> bit & np.uint64(1)).astype(bool)
            below = words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[at[hit]] = self._ranks[level][word[hit]] + np.bitwise_count(below)
            at = at[~hit]
        if len(at) and len(self.rest):
            found = np.minimum(np.searchsorted(self.rest, keys[at]), len(self.rest) - 1)
            here = self.rest[found] == keys[at]
            out[at[here]] = self._first_rest + found[here]
        return out

    def arrays(self) -> dict[str, np.ndarray]:
        return {f"level{i:02d}": words for i, words in enumerate(self.levels)} | {"rest": self.rest}

    @staticmethod
    def of_arrays(arrays: dict[str, np.ndarray]) -> PerfectHash:
        return PerfectHash([arrays[name] for name in sorted(arrays) if name.startswith("level")], arrays["rest"])
