"""FM-index over numbers 0..size-1: suffix array, wavelet-tree ranks, sampled suffix positions."""

from __future__ import annotations

import numpy as np

#: every so many text positions keeps its suffix position
SAMPLE = 16
BLOCK = 64


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling the sorted length; only unsettled suffixes are sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    ranked = text[order]
    begin = np.flatnonzero(np.diff(ranked, prepend=ranked[:1] - 1)) if n else np.empty(0, np.int64)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(begin, np.diff(np.append(begin, n)))
    width = 1
    while True:
        same = np.zeros(n, bool)
        same[:-1] = rank[order[:-1]] == rank[order[1:]]
        same[1:] |= same[:-1]
        slots = np.flatnonzero(same)
        if not len(slots):
            return order
        who = order[slots]
        after = who + width
        follow = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        group = rank[who]
        sub = np.lexsort((follow, group))
        who, follow, group = who[sub], follow[sub], group[sub]
        order[slots] = who
        new = np.ones(len(who), bool)
        new[1:] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
        rank[who] = slots[np.maximum.accumulate(np.where(new, np.arange(len(who)), 0))]
        width *= 2


class Bits:
    """A bit vector with the number of ones before any position."""

    def __init__(self, bits: np.ndarray) -> None:
        self.n = len(bits)
        padded = np.zeros(-(-(self.n + 1) // BLOCK) * BLOCK, np.uint8)
        padded[:self.n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)


class WaveletTree:
    """Ranks of symbols: one bit vector a level, symbols split by their highest open bit.

    Each level holds the symbols stably sorted by the bits above it, so a node is an interval.
    """

    def __init__(self, symbols: np.ndarray, size: int) -> None:
        self.depth = max(1, int(size - 1).bit_length())
        self.levels, self.zeros = [], []
        at = symbols
        for level in range(self.depth - 1, -1, -1):
            bit = ((at >> level) & 1).astype(np.uint8)
            bits = Bits(bit)
            self.levels.append(bits)
            self.zeros.append(len(at) - int(bit.sum()))
            at = np.concatenate([at[bit == 0], at[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many of each symbol stand before each position."""
        low, high = np.zeros(len(at), np.int64), at.astype(np.int64)
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = (symbol >> (self.depth - 1 - k)) & 1 == 1
            a, b = bits.ones(low), bits.ones(high)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return high - low

    def symbol(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and its rank there."""
        low, here = np.zeros(len(at), np.int64), at.astype(np.int64)
        out = np.zeros(len(at), np.int64)
        for bits, zeros in zip(self.levels, self.zeros):
            one = bits.get(here) == 1
            a, b = bits.ones(low), bits.ones(here)
            low, here = np.where(one, zeros + a, low - a), np.where(one, zeros + b, here - b)
            out = out * 2 + one
        return out, here - low


class FMIndex:
    """text must end with a symbol 0 that occurs nowhere else in it."""

    def __init__(self, text: np.ndarray, size: int) -> None:
        order = suffix_array(text)
        self.n = len(text)
        self.bwt = WaveletTree(text[order - 1], size)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))]).astype(np.int64)
        marked = order % SAMPLE == 0
        self.marked, self.sampled = Bits(marked.astype(np.uint8)), order[marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each phrase (row, padded at the right) the interval of suffixes that begin with it."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for step in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((lengths > step) & (low < high))
            symbol = phrases[live, lengths[live] - 1 - step].astype(np.int64)
            low[live] = self.first[symbol] + self.bwt.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.bwt.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text position of each row of the suffix order: step back until a sampled one."""
        out, walked = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        open_, at = np.arange(len(rows)), rows.astype(np.int64)
        while len(open_):
            done = self.marked.get(at) == 1
            out[open_[done]] = self.sampled[self.marked.ones(at[done])] + walked[open_[done]]
            open_, at = open_[~done], at[~done]
            symbol, rank = self.bwt.symbol(at)
            at = self.first[symbol] + rank
            walked[open_] += 1
        return out
