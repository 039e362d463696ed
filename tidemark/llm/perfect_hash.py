"""A minimal perfect hash over 128-bit keys, with a compact fingerprint and count for each key.

Keys are dealt to the bits of a level by a hash of that level; a bit that just one key meets is
set and stands for it, the other keys go on to the next, smaller level. The number of set bits
before a key's bit is its place in the arrays: places run from 0 to the number of keys less
one. A level takes about two bits a key.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tidemark.llm.segments import mixed

#: Bits of a level for each key that reaches it. Levels after which what is left is kept by name.
GAMMA, LEVELS = 2, 40


def _bit(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = mixed(np.full(1, level + 1, np.uint64))
    return (mixed(keys[:, 0] ^ seed) + mixed(keys[:, 1] + seed)) % np.uint64(size)


def _words(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, bitorder="little").view("<u8")


@dataclass
class PerfectHash:
    """``sizes`` are the bits of each level; ``words`` the bits of all levels, end to end."""

    sizes: np.ndarray
    words: np.ndarray
    fingerprints: np.ndarray
    counts: np.ndarray

    def __post_init__(self) -> None:
        self._before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, most: int) -> PerfectHash:
        """For different keys (rows of two words) with their counts; counts above ``most`` are kept as ``most``."""
        sizes, levels, left = [], [], keys
        while len(left):
            if len(levels) == LEVELS:
                raise ValueError("keys of a perfect hash must differ")
            size = 64 * max(1, -(-GAMMA * len(left) // 64))
            at = _bit(left, len(levels), size)
            met = np.bincount(at.astype(np.int64), minlength=size)
            sizes.append(size)
            levels.append(_words(met == 1))
            left = left[met[at] > 1]
        kind = np.uint16 if most < 1 << 16 else np.uint32
        made = cls(np.array(sizes, np.int64), np.concatenate([np.zeros(0, "<u8"), *levels]), np.zeros(len(keys), np.uint32), np.zeros(len(keys), kind))
        place = made._place(keys)
        made.fingerprints[place] = _fingerprint(keys)
        made.counts[place] = np.minimum(counts, most)
        return made

    def _place(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1 for one that no level knows."""
        place, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = _bit(keys[left], level, size).astype(np.int64) + base
            word, low = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> low & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << low) - np.uint64(1)))
            place[left[hit]] = (self._before[at >> 6] + below)[hit]
            left, base = left[~hit], base + size
        return place

    def count(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key; 0 for a key that has another fingerprint than the one at its place."""
        if not len(self.counts):
            return np.zeros(len(keys), np.int64)
        place = self._place(keys)
        same = (place >= 0) & (self.fingerprints[place] == _fingerprint(keys))
        return np.where(same, self.counts[place], 0).astype(np.int64)


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys[:, 0] + np.uint64(0x51ED)) ^ keys[:, 1]).astype(np.uint32)
