"""A compressed FM-index over word sequences: the Burrows-Wheeler transform in a wavelet tree.

The tree is kept level by level (a wavelet matrix): one bit per symbol and level, packed into
64-bit words with a running count for each, so a rank is one lookup and one population count.
"""

from __future__ import annotations

import numpy as np


def dense(symbols: np.ndarray) -> np.ndarray:
    """Symbols numbered from 1 by their order."""
    if len(symbols) and symbols.dtype.kind in "iu" and symbols.min() >= 0 and symbols.max() < 4 * len(symbols) + 256:
        used = np.zeros(int(symbols.max()) + 1, np.int64)
        used[symbols] = 1
        return np.cumsum(used)[symbols]
    return np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1


def suffix_order(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order, by prefix doubling. ``ends`` are the ascending places of the end
    marks, the last symbol among them; these are different from each other and smaller than any symbol.

    The first sort takes as many symbols as fit a number; then only suffixes that still share their rank are
    sorted. A rank is the place of the first suffix that has it.
    """
    n = len(symbols)
    code = dense(symbols)
    code[ends] = 0
    bits = int(code.max()).bit_length()
    step = max(1, 63 // max(1, bits))
    places = np.arange(n)
    left = ends[np.searchsorted(ends, places)] - places  # symbols before the end mark
    key = code
    for k in range(1, step):
        key = key << bits
        key[:n - k] |= np.where(left[:n - k] > k, code[k:], 0)
    order = np.argsort(key, kind="stable")
    new = np.ones(n + 1, bool)
    # Two suffixes that end alike are told apart by their end marks, which rise with the place.
    new[1:-1] = (key[order[1:]] != key[order[:-1]]) | (left[order[1:]] < step)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new[:-1], places, 0))
    slots = np.nonzero(~(new[:-1] & new[1:]))[0]
    while len(slots):
        at = order[slots]
        key = rank[at] * n + rank[at + step]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        new = np.ones(len(at) + 1, bool)
        new[1:-1] = key[1:] != key[:-1]
        order[slots] = at
        rank[at] = np.maximum.accumulate(np.where(new[:-1], slots, 0))
        slots = slots[~(new[:-1] & new[1:])]
        step *= 2
    return order


class WaveletTree:
    """Ranks of symbols 0..sigma-1 in a sequence."""

    def __init__(self, values: np.ndarray, sigma: int) -> None:
        self.levels = max(1, int(sigma - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        start = np.zeros(sigma, np.int64)
        symbol = np.arange(sigma)
        for level in range(self.levels - 1, -1, -1):
            bits = (values >> level & 1).astype(bool)
            packed = np.packbits(bits, bitorder="little")
            words = np.zeros(len(values) // 64 + 1, np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            self.words.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words[:-1]).astype(np.int64))]))
            self.zeros.append(len(values) - int(bits.sum()))
            start = self._down(len(self.words) - 1, start, (symbol >> level & 1).astype(bool))
            values = np.concatenate([values[~bits], values[bits]])
        self.start = start

    def _down(self, k: int, at: np.ndarray, bit: np.ndarray) -> np.ndarray:
        block = at >> 6
        below = self.words[k][block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        ones = self.counts[k][block] + np.bitwise_count(below)
        return np.where(bit, self.zeros[k] + ones, at - ones)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        start = self.start[symbol]
        for k in range(self.levels):
            at = self._down(k, at, (symbol >> (self.levels - 1 - k) & 1).astype(bool))
        return at - start


class FMIndex:
    """Texts of dense symbols (1 and up), each closed by an end mark 0."""

    def __init__(self, texts: list[np.ndarray]) -> None:
        lens = np.array([len(t) for t in texts])
        self.starts = np.cumsum(lens + 1) - lens - 1
        joined = np.concatenate([np.concatenate([t, np.zeros(1, t.dtype)]) for t in texts])
        ends = self.starts + lens
        values, dense = np.unique(np.delete(joined, ends), return_inverse=True)
        self.text = np.zeros(len(joined), np.int64)
        inner = np.ones(len(joined), bool)
        inner[ends] = False
        self.text[inner] = dense + 1
        sigma = len(values) + 1
        order = suffix_order(self.text, ends)
        before = self.text[order - 1]  # of the first suffix of a text: the end mark before it
        self.tree = WaveletTree(before, sigma)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=sigma))[:-1]])
        self.size = len(joined)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: from the suffixes that start with w to those that start with symbol + w."""
        both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        first = self.first[symbol]
        return first + both[:len(lo)], first + both[len(lo):]


def repeated_windows(texts: list[np.ndarray], length: int, skip: np.ndarray) -> np.ndarray:
    """A bit for each window of each streamed text: does it occur twice or more in the index?

    Matching statistics with a threshold. First each text is matched from its end for as long as
    it occurs twice; that settles the windows after the longest match. Then windows are matched
    from the left: a match that ends at p before the window is complete shows that every window
    from here to p holds a sequence that occurs only once, so the next to try is p + 1.
    """
    index = FMIndex(texts)
    lens = np.array([len(t) for t in texts])
    bits = np.zeros(len(texts), np.uint64)
    lane = np.nonzero(~skip)[0]
    base = index.starts[lane]
    end, floor = lens[lane] - 1, np.zeros(len(lane), np.int64)
    last = lens[lane] - length  # last window still to settle
    at, lo, hi = end.copy(), np.zeros(len(lane), np.int64), np.full(len(lane), index.size)
    first_match = np.ones(len(lane), bool)
    one = np.uint64(1)
    while len(lane):
        lo, hi = index.extend(index.text[base + at], lo, hi)
        failed = hi - lo < 2
        done = ~failed & (at == floor)
        ready = np.nonzero(failed | done)[0]
        at = at - 1
        if not len(ready):
            continue
        k, p = lane[ready], at[ready] + 1
        was_first, ok = first_match[ready], done[ready]
        # The long match: windows from p + 1 on are settled as repeated, one that holds [p, end] as not.
        tops = last[ready]
        low = np.where(ok, 0, p + 1)
        many = np.where(was_first, np.maximum(0, tops - low + 1), np.where(ok, 1, 0)).astype(np.uint64)
        shift = np.where(was_first, np.minimum(low, 63), floor[ready]).astype(np.uint64)
        mask = np.where(many >= 64, ~np.uint64(0), (one << np.minimum(many, np.uint64(63))) - one) << shift
        bits[k] |= np.where(many > 0, mask, np.uint64(0))
        last[ready] = np.where(was_first, np.where(ok, -1, np.minimum(p, tops - 1)), tops)
        floor[ready] = np.where(was_first, 0, np.where(ok, floor[ready] + 1, p + 1))
        first_match[ready] = False
        end[ready] = floor[ready] + length - 1
        at[ready] = end[ready]
        lo[ready], hi[ready] = 0, index.size
        live = floor <= last
        if not live.all():
            lane, base, end, floor, last, at, lo, hi, first_match = (
                x[live] for x in (lane, base, end, floor, last, at, lo, hi, first_match))
    return bits
