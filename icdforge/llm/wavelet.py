"""A wavelet matrix over small symbols, with vectorised rank queries and select
by bisection on ranks."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


class Bits:
    """A bit row with the number of ones before any position."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Symbols below 2 ** ``bits``; one bit row a level, highest bit first,
    zeros of a level stably before its ones in the next."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.length, self.bits, self.levels = len(symbols), bits, []
        for k in reversed(range(bits)):
            one = (symbols >> k & 1).astype(bool)
            self.levels.append(Bits(one))
            symbols = np.concatenate([symbols[~one], symbols[one]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before each position of ``at``."""
        low, high = np.zeros(1, np.int64), np.asarray(at, np.int64)
        for k, level in zip(reversed(range(self.bits)), self.levels):
            if symbol >> k & 1:
                low, high = level.zeros + level.ones(low), level.zeros + level.ones(high)
            else:
                low, high = low - level.ones(low), high - level.ones(high)
        return high - low

    def count(self, symbols: Iterable[int], at: np.ndarray) -> np.ndarray:
        """How many of ``symbols`` occur before each position; ranks of the
        others are taken from the position where they are fewer."""
        wanted = set(symbols)
        others = set(range(1 << self.bits)) - wanted
        at = np.asarray(at, np.int64)
        if len(others) < len(wanted):
            return at - sum((self.rank(s, at) for s in others), np.zeros(len(at), np.int64))
        return sum((self.rank(s, at) for s in wanted), np.zeros(len(at), np.int64))

    def select(self, symbols: Iterable[int], k: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Per query the first position p in [low, high] with ``k`` of
        ``symbols`` in [low, p), by bisection on the ranks (``high`` if there
        are not that many)."""
        wanted = set(symbols)
        goal = self.count(wanted, low) + k
        low, high = np.array(low, np.int64), np.array(high, np.int64)
        while (low < high).any():
            middle = low + high >> 1
            enough = self.count(wanted, middle) >= goal
            high, low = np.where(enough, middle, high), np.where(enough, low, np.minimum(middle + 1, high))
        return low
