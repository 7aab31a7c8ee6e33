"""An FM-index over integer sequences, in numpy: suffix order, wavelet ranks, sampled positions.

All searches run together: each step of the backward search is a few array operations for all
phrases at once.
"""

from __future__ import annotations

import numpy as np

SAMPLE_STEP = 8


def suffix_order(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Sorted suffixes of a sequence, by prefix doubling; with ``depth``, by their first ``depth`` symbols at least.

    A suffix that another one begins with comes first. Only suffixes that are not yet told apart
    are sorted again.
    """
    n = len(text)
    order = np.argsort(text)
    rank = np.empty(n + 1, np.int64)  # the place of the first suffix not told apart from it; the end comes before all
    rank[n] = -1
    rank[order] = run_starts(text[order])
    width, open_ = 1, _shared(rank[order])
    while len(open_) and width < (depth or n):
        part = order[open_]
        key = rank[part] * np.int64(n + 1) + rank[np.minimum(part + width, n)] + 1
        again = np.argsort(key)
        part, key = part[again], key[again]
        order[open_] = part
        new = np.ones(len(part), bool)
        new[1:] = key[1:] != key[:-1]
        rank[part] = carried(np.where(new, open_, -1))
        open_ = open_[_shared(rank[part])]
        width *= 2
    return order


def run_starts(values: np.ndarray) -> np.ndarray:
    """For sorted values, the place of the first equal one."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return carried(np.where(new, np.arange(len(values)), -1))


def carried(values: np.ndarray) -> np.ndarray:
    """Each -1 replaced by the last other value before it."""
    return values[np.maximum.accumulate(np.where(values >= 0, np.arange(len(values)), 0))]


def _shared(ranks: np.ndarray) -> np.ndarray:
    """Places in a sorted list whose value stands beside an equal one."""
    same = np.concatenate([[False], ranks[1:] == ranks[:-1], [False]])
    return np.flatnonzero(same[1:] | same[:-1])


class WaveletRanks:
    """A wavelet matrix: per bit, high to low, the zeros come first and the ones after, in order."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for b in range(bits - 1, -1, -1):
            one = (symbols >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(one, dtype=np.int32)]))
            self.zeros.append(len(symbols) - int(self.ones[-1][-1]))
            symbols = np.concatenate([symbols[one == 0], symbols[one == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``place``."""
        low, high = np.zeros_like(place), place
        for ones, zeros, b in zip(self.ones, self.zeros, range(self.bits - 1, -1, -1)):
            one = ((symbol >> b) & 1).astype(bool)
            low = np.where(one, zeros + ones[low], low - ones[low])
            high = np.where(one, zeros + ones[high], high - ones[high])
        return high - low

    def symbol(self, place: np.ndarray) -> np.ndarray:
        found = np.zeros_like(place)
        for ones, zeros in zip(self.ones, self.zeros):
            one = ones[place + 1] - ones[place]
            found = found * 2 + one
            place = np.where(one == 1, zeros + ones[place], place - ones[place])
        return found


class FMIndex:
    """Index of a text of symbols 0 (its last, once) to ``size`` - 1."""

    def __init__(self, text: np.ndarray, size: int):
        order = suffix_order(text)
        last = text[order - 1]
        self.ranks = WaveletRanks(last, max(1, int(size - 1).bit_length()))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))]).astype(np.int64)
        self.sampled = order % SAMPLE_STEP == 0
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = order[self.sampled]
        self.length = len(text)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [low, high) of phrases (one per row, all of one length), by backward search."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.length, np.int64)
        live = np.arange(len(phrases))
        for i in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, i]
            low[live] = self.before[c] + self.ranks.rank(c, low[live])
            high[live] = self.before[c] + self.ranks.rank(c, high[live])
            live = live[low[live] < high[live]]
        high[high < low] = low[high < low]
        dead = np.ones(len(phrases), bool)
        dead[live] = False
        high[dead] = low[dead]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix order: step back to a sampled one."""
        found, steps = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        live, at = np.arange(len(rows)), rows.astype(np.int64)
        while len(live):
            here = self.sampled[at]
            found[live[here]] = self.samples[self.sample_rank[at[here]]] + steps[live[here]]
            live, at = live[~here], at[~here]
            c = self.ranks.symbol(at)
            at = self.before[c] + self.ranks.rank(c, at)
            steps[live] += 1
        return found
