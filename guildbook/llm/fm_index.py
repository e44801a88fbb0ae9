"""A compressed FM-index over words, and matching statistics of many passages at once, in numpy."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with rank: 64 bits to a word, and the ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = len(bits) - int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before place i."""
        at = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & below)


class WaveletTree:
    """Rank of any symbol in a sequence of small numbers, level by level from the highest bit (the levels of a wavelet matrix)."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.depth = max(1, int(symbols - 1).bit_length())
        self.levels, left = [], sequence
        for level in range(self.depth - 1, -1, -1):
            bit = (left >> level) & 1
            self.levels.append(Bits(bit))
            left = np.concatenate([left[bit == 0], left[bit == 1]])
        every = np.arange(symbols)
        self.origin = self._down(every, np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, bits in zip(range(self.depth - 1, -1, -1), self.levels, strict=True):
            ones = bits.rank(i)
            i = np.where((symbol >> level) & 1 == 1, bits.zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before place i."""
        return self._down(symbol, i) - self.origin[symbol]


def _dense(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return np.unique(high * (int(low.max()) + 1) + low, return_inverse=True)[1].astype(np.int64)


class FMIndex:
    """Index of a text of symbols (0 ends a passage), for patterns of up to `width` symbols.

    Suffixes are ordered by their first 2^k >= width + 1 symbols, by doubling; for patterns no longer than that, backward
    search gives the same ranges as with a full suffix array. What stays of the suffixes is a bit for each (whether it differs from
    the one before it within width - 1 symbols) and, in their order, one 32-bit value of the caller's for each."""

    def __init__(self, text: np.ndarray, symbols: int, width: int, value: np.ndarray):
        self.width, self.n = width, len(text)
        ranks = {1: text.astype(np.int64)}
        step = 1
        while step <= width:
            r = ranks[step]
            ranks[2 * step] = _dense(r, np.append(r[step:] + 1, np.zeros(min(step, self.n), np.int64))[: self.n])
            step *= 2
        places = np.argsort(ranks[step], kind="stable")
        self.tree = WaveletTree(text[places - 1], symbols)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.value = value[places].astype(np.int32)
        differs = self._differs(ranks, width - 1, places)
        self.differs, self.begins = Bits(differs), np.append(np.flatnonzero(differs), self.n).astype(np.int32)

    def _differs(self, ranks: dict[int, np.ndarray], depth: int, places: np.ndarray) -> np.ndarray:
        """For each suffix in order whether its first `depth` symbols are others than those of the suffix before it."""
        out, at = np.zeros(self.n, bool), 0
        out[:1] = True
        for size in sorted(ranks, reverse=True):
            if depth & size:
                part = np.append(ranks[size][at:] + 1, np.zeros(min(at, self.n), np.int64))[: self.n][places]
                out[1:] |= part[1:] != part[:-1]
                at += size
        return out

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the ranges of symbol + pattern from those of the patterns."""
        return self.less[symbol] + self.tree.rank(symbol, low), self.less[symbol] + self.tree.rank(symbol, high)

    def shorten(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of the patterns without their last symbol, from patterns of full width."""
        at = self.differs.rank(low + 1)
        return self.begins[at - 1].astype(np.int64), self.begins[at].astype(np.int64)

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least value in each range of a pattern of full width; such ranges are equal or apart, so each is read once."""
        if not len(low):
            return low
        begin, first, which = np.unique(low, return_index=True, return_inverse=True)
        edges = np.stack([begin, high[first]], axis=1).ravel()
        values = np.append(self.value, np.iinfo(np.int32).max)
        return np.minimum.reduceat(values, edges)[::2][which]

    def windows(self, text: np.ndarray, begin: np.ndarray, length: np.ndarray):
        """Streams passages of a text from their ends: yields for each step (which passages, the place in the text where their
        window of full width begins, low and high of its range). The matching statistic there is the width, if high > low."""
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        low, high = np.zeros(len(order), np.int64), np.full(len(order), self.n, np.int64)
        for t in range(int(length[0]) if len(length) else 0):
            m = int(np.searchsorted(-length, -t, "left"))  # passages of more than t symbols
            low, high = low[:m], high[:m]
            place = begin[:m] + length[:m] - 1 - t
            if t >= self.width:
                low, high = self.shorten(low)
            low, high = self.extend(text[place], low, high)
            if t >= self.width - 1:
                yield order[:m], place, low, high
