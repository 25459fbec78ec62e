"""Elias-Fano sequences with vectorised access and successor search.

A monotone sequence of n numbers below u keeps the low log2(u / n) bits of
each number packed and the high parts in unary, about 2 + log2(u / n) bits
a number. Arrays live in anonymous memory maps. Ones and zeros are
selected by a count per 64-bit word and a halving search inside the word.
"""

from __future__ import annotations

import mmap

import numpy as np


def mapped(values: np.ndarray) -> np.ndarray:
    """A copy of ``values`` in a memory map of its own."""
    out = np.frombuffer(mmap.mmap(-1, max(values.nbytes, 1)), values.dtype, len(values))
    out[:] = values
    return out


def _select_in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th (from 0) set bit of each word."""
    at = np.zeros(len(word), np.int64)
    for half in (32, 16, 8, 4, 2, 1):
        low = np.bitwise_count(word & np.uint64((1 << half) - 1)).astype(np.int64)
        over = k >= low
        k = np.where(over, k - low, k)
        word = np.where(over, word >> np.uint64(half), word)
        at += np.where(over, half, 0)
    return at


class EliasFano:
    def __init__(self, values: np.ndarray, universe: int):
        """``values``: sorted, each below ``universe``."""
        n = len(values)
        values = values.astype(np.int64)
        self.n = n
        self.low_bits = max(0, int(universe // max(n, 1)).bit_length() - 1)
        self._mask = np.uint64((1 << self.low_bits) - 1)
        low = values.astype(np.uint64) & self._mask
        words = np.zeros(n * self.low_bits // 64 + 2, np.uint64)
        if self.low_bits:
            bit = np.arange(n, dtype=np.int64) * self.low_bits
            word, shift = bit >> 6, (bit & 63).astype(np.uint64)
            np.bitwise_or.at(words, word, low << shift)
            over = np.flatnonzero(shift + np.uint64(self.low_bits) > 64)
            np.bitwise_or.at(words, word[over] + 1, low[over] >> (np.uint64(64) - shift[over]))
        self._low = mapped(words)
        size = n + (int(universe) >> self.low_bits) + 2
        bits = np.zeros(-(-size // 64) * 64, np.uint8)
        bits[(values >> self.low_bits) + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view("<u8").astype(np.uint64)
        ones = np.bitwise_count(high).astype(np.int64)
        self._high = mapped(high)
        self._ones = mapped(np.cumsum(ones) - ones)
        self._zeros = mapped(np.arange(len(high), dtype=np.int64) * 64 - self._ones)

    @property
    def bytes(self) -> int:
        return sum(a.nbytes for a in (self._low, self._high, self._ones, self._zeros))

    def _low_of(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        left = np.where(shift > 0, self._low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((self._low[word] >> shift) | left) & self._mask

    def access(self, i: np.ndarray) -> np.ndarray:
        """The numbers at the given places."""
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self._ones, i, side="right") - 1
        at = (word << 6) + _select_in_word(self._high[word], i - self._ones[word])
        return ((at - i) << self.low_bits) | self._low_of(i).astype(np.int64)

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of each number (of its successor, if that equals it),
        -1 if it is not in the sequence."""
        x = np.asarray(x, np.int64)
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        high, low = x >> self.low_bits, x.astype(np.uint64) & self._mask
        # numbers with this high part: between the (high - 1)-th zero and the next
        begin, end = np.where(high > 0, self._zero(np.maximum(high - 1, 0)) + 1, 0) - high, self._zero(high) - high
        lanes = np.flatnonzero(begin < end)
        begin, end, low = begin[lanes], end[lanes], low[lanes]
        while len(lanes):
            middle = (begin + end) >> 1
            have = self._low_of(middle)
            hit = have == low
            out[lanes[hit]] = middle[hit]
            less = have < low
            begin, end = np.where(less, middle + 1, begin), np.where(less, end, middle)
            on = ~hit & (begin < end)
            lanes, begin, end, low = lanes[on], begin[on], end[on], low[on]
        return out

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th zero of the high parts (their end, if there are fewer)."""
        word = np.minimum(np.searchsorted(self._zeros, k, side="right") - 1, len(self._high) - 1)
        return (word << 6) + _select_in_word(~self._high[word], k - self._zeros[word])
