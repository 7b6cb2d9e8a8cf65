"""An FM-index over a sequence of small integers, searched for many patterns at once.

Symbol 0 is a break: no pattern holds it, and every break counts as a symbol of its
own, smaller than all others, so that no suffix is compared beyond the next break.
"""

from __future__ import annotations

import numpy as np

from bugtide.llm.tools import ranges, run_starts

#: One suffix position in so many is kept, beside those that follow a break.
SAMPLE = 8


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Ranks of all suffixes, by doubling; only groups that still tie are sorted again."""
    n = len(symbols)
    breaks = np.flatnonzero(symbols == 0)
    rank = symbols.astype(np.int64) + len(breaks)
    rank[breaks] = np.arange(len(breaks))
    order = np.argsort(rank, kind="stable")
    starts = run_starts(rank[order])
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    sizes = np.diff(np.append(starts, n))
    tied = order[np.repeat(sizes > 1, sizes)]
    step = 1
    while len(tied):
        ahead = tied + step
        follow = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        own = rank[tied]
        by = np.lexsort((follow, own))
        tied, own, follow = tied[by], own[by], follow[by]
        fresh = np.concatenate([[True], (own[1:] != own[:-1]) | (follow[1:] != follow[:-1])])
        groups = run_starts(own)
        at = np.arange(len(tied))
        start = np.flatnonzero(fresh)
        inside = np.repeat(start, np.diff(np.append(start, len(tied))))
        outer = np.repeat(groups, np.diff(np.append(groups, len(tied))))
        rank[tied] = own + inside - outer
        sizes = np.diff(np.append(start, len(tied)))
        tied = tied[np.repeat(sizes > 1, sizes)]
        step *= 2
    return rank


class Bits:
    """A bit vector with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.total = int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, inside = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << inside) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)

    def at(self, where: np.ndarray) -> np.ndarray:
        return (self.words[where >> 6] >> (where & 63).astype(np.uint64)) & np.uint64(1)


class Wavelet:
    """A wavelet matrix: ranks and symbols of a sequence, one bit vector a level."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.bits, self.zeros = [], []
        current = sequence
        for level in reversed(range(self.levels)):
            bit = ((current >> level) & 1).astype(bool)
            self.bits.append(Bits(bit))
            self.zeros.append(len(bit) - self.bits[-1].total)
            current = np.concatenate([current[~bit], current[bit]])
        self.first = self._down(np.arange(symbols), np.zeros(symbols, dtype=np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for depth, (bits, zeros) in enumerate(zip(self.bits, self.zeros, strict=True)):
            ones = bits.ones(at)
            up = (symbol >> (self.levels - 1 - depth)) & 1
            at = np.where(up == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``at``."""
        return self._down(symbol, at) - self.first[symbol]

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbol = np.zeros(len(at), dtype=np.int64)
        for bits, zeros in zip(self.bits, self.zeros, strict=True):
            bit = bits.at(at).astype(np.int64)
            ones = bits.ones(at)
            at = np.where(bit == 1, zeros + ones, at - ones)
            symbol = symbol * 2 + bit
        return symbol, at - self.first[symbol]


class FMIndex:
    def __init__(self, sequence: np.ndarray, symbols: int, sample: int = SAMPLE):
        """``sequence`` holds 0 (a break) to ``symbols - 1``; a break ends it."""
        if not len(sequence) or sequence[-1]:
            sequence = np.append(sequence, 0)
        n = len(sequence)
        rank = suffix_order(sequence)
        suffixes = np.empty(n, dtype=np.int64)
        suffixes[rank] = np.arange(n)
        self.transform = Wavelet(sequence[suffixes - 1], symbols)
        counts = np.bincount(sequence, minlength=symbols)
        self.below = np.concatenate([[0], np.cumsum(counts)])
        kept = (suffixes % sample == 0) | (sequence[suffixes - 1] == 0)
        self.marked = Bits(kept)
        self.sampled = suffixes[kept]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of equally long patterns, the first row of the index and the one past the last."""
        last = patterns[:, -1]
        low, high = self.below[last], self.below[last + 1]
        for column in range(patterns.shape[1] - 2, -1, -1):
            live = np.flatnonzero(low < high)
            if not len(live):
                break
            symbol = patterns[live, column]
            low[live] = self.below[symbol] + self.transform.rank(symbol, low[live])
            high[live] = self.below[symbol] + self.transform.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in the given rows, by walking to a sampled one."""
        found = np.zeros(len(rows), dtype=np.int64)
        open_, at, steps = np.arange(len(rows)), rows, 0
        while len(open_):
            done = self.marked.at(at) == 1
            found[open_[done]] = self.sampled[self.marked.ones(at[done])] + steps
            open_, at = open_[~done], at[~done]
            if len(at):
                symbol, rank = self.transform.symbol_and_rank(at)
                at = self.below[symbol] + rank
            steps += 1
        return found

    def occurrences(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the pattern, position) of every occurrence."""
        low, high = self.search(patterns)
        which = np.repeat(np.arange(len(patterns)), high - low)
        return which, self.locate(ranges(low, high - low))
