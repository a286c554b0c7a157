"""FM-index of a word sequence: suffix array, Burrows-Wheeler transform, wavelet ranks and sampled positions."""
from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling on ranks; zeros are separators, each different from all others."""
    n = len(text)
    rank = text.astype(np.int64)
    zero = np.flatnonzero(rank == 0)
    rank += len(zero)
    rank[zero] = np.arange(len(zero))
    order = np.argsort(rank, kind="stable")
    step = 1
    while True:
        sorted_rank = rank[order]
        fresh = np.empty(n, dtype=bool)
        fresh[:1] = True
        if step == 1:
            fresh[1:] = sorted_rank[1:] != sorted_rank[:-1]
        else:
            fresh[1:] = key[order][1:] != key[order][:-1]
        number = np.cumsum(fresh) - 1
        rank = np.empty(n, dtype=np.int64)
        rank[order] = number
        if n == 0 or number[-1] == n - 1:
            return order
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        # only suffixes whose rank is shared have to be sorted again, inside their places
        shared = ~fresh
        shared[:-1] |= ~fresh[1:]
        places = np.flatnonzero(shared)
        part = order[places]
        order[places] = part[np.argsort(key[part], kind="stable")]
        step *= 2


class WaveletRanks:
    """Bits of the symbols, most significant first, each level with running counts of ones (a wavelet matrix)."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            count = np.zeros(len(symbols) + 1, dtype=np.int32)
            np.cumsum(ones, out=count[1:])
            self.levels.append((bit, count, len(symbols) - int(count[-1])))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def move(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where the boundary ``place`` ends up among the symbols equal to ``symbol``."""
        for bit, count, zeros in self.levels:
            ones = count[place]
            place = np.where(symbol >> bit & 1, zeros + ones, place - ones)
        return place


class FMIndex:
    """Index of ``text``: positive symbols, every stretch ended by a zero. Patterns never hold a zero."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 8):
        order = suffix_array(text)
        self.last = text[order - 1]  # the symbol before each suffix; the one before the first is the closing zero
        ranks = WaveletRanks(self.last, max(1, int(symbols).bit_length()))
        self.ranks = ranks
        every = np.arange(symbols + 1)
        smaller = np.cumsum(np.bincount(text, minlength=symbols + 1)) - np.bincount(text, minlength=symbols + 1)
        self.base = smaller - ranks.move(every, np.zeros(symbols + 1, dtype=np.int64))
        marked = (order % sample == 0) | (self.last == 0)  # a walk never has to cross a separator
        self.marked, self.before, self.places = marked, np.cumsum(marked) - 1, order[marked]

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.base[symbol] + self.ranks.move(symbol, row)

    def find(self, patterns: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range of the suffixes that begin with each pattern (rows of ``patterns``, left-aligned)."""
        low, high = np.zeros(len(length), dtype=np.int64), np.full(len(length), len(self.last), dtype=np.int64)
        for back in range(1, int(length.max(initial=0)) + 1):
            on = np.flatnonzero((length >= back) & (low < high))
            symbol = patterns[on, length[on] - back]
            low[on], high[on] = self.step(symbol, low[on]), self.step(symbol, high[on])
        return low, high

    def locate(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pattern number and text place of every occurrence."""
        count = np.maximum(high - low, 0)
        which = np.repeat(np.arange(len(low)), count)
        row = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + low[which]
        walked = np.zeros(len(row), dtype=np.int64)
        while True:
            on = np.flatnonzero(~self.marked[row])
            if not len(on):
                return which, self.places[self.before[row]] + walked
            row[on] = self.step(self.last[row[on]], row[on])
            walked[on] += 1
