"""Probabilistic automata inferred from strings by merging the states of their prefix tree.

A state keeps how often strings pass it, end in it and go on by each symbol. Two states are
compatible if these shares, and those of all states that follow them by equal symbols, differ by no more
than Hoeffding's bound allows. States are taken breadth first: each is merged into the first
compatible one that was kept before, or kept itself.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np


class Automaton:
    """Log probabilities by state: of each symbol (with the state it leads to) and of the end."""

    def __init__(self, strings: Sequence[Sequence[int]], symbols: int, alpha: float = 0.05):
        self.symbols = symbols
        self.passed, self.ended, self.goes, self.count = [0], [0], [{}], [{}]
        for s in strings:
            self._add(s)
        self.bound = (0.5 * np.log(2 / alpha)) ** 0.5
        self._merge_all()
        self._compile()

    def _add(self, s: Sequence[int]) -> None:
        state = 0
        self.passed[0] += 1
        for c in s:
            if c not in self.goes[state]:
                self.goes[state][c] = len(self.passed)
                self.passed.append(0)
                self.ended.append(0)
                self.goes.append({})
                self.count.append({})
            self.count[state][c] = self.count[state].get(c, 0) + 1
            state = self.goes[state][c]
            self.passed[state] += 1
        self.ended[state] += 1

    def _alike(self, n: int, of_n: int, m: int, of_m: int) -> bool:
        if not of_n or not of_m:
            return True
        return abs(n / of_n - m / of_m) <= self.bound * (of_n**-0.5 + of_m**-0.5)

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if not self._alike(self.ended[a], self.passed[a], self.ended[b], self.passed[b]):
                return False
            for c in self.count[a].keys() | self.count[b].keys():
                if not self._alike(self.count[a].get(c, 0), self.passed[a], self.count[b].get(c, 0), self.passed[b]):
                    return False
                if c in self.goes[a] and c in self.goes[b] and self.goes[a][c] != self.goes[b][c]:
                    todo.append((self.goes[a][c], self.goes[b][c]))
        return True

    def _fold(self, kept: int, other: int) -> None:
        """Add the tree below ``other`` to ``kept``."""
        todo = [(kept, other)]
        while todo:
            a, b = todo.pop()
            self.passed[a] += self.passed[b]
            self.ended[a] += self.ended[b]
            for c, n in self.count[b].items():
                self.count[a][c] = self.count[a].get(c, 0) + n
                if c in self.goes[a]:
                    todo.append((self.goes[a][c], self.goes[b][c]))
                else:
                    self.goes[a][c] = self.goes[b][c]

    def _merge_all(self) -> None:
        kept, known = [0], {0}
        edge = deque((0, c) for c in sorted(self.goes[0]))
        while edge:
            parent, c = edge.popleft()
            state = self.goes[parent][c]
            if state in known:
                continue
            for k in kept:
                if self._compatible(k, state):
                    self.goes[parent][c] = k
                    self._fold(k, state)
                    # the fold may have given kept states new successors
                    edge.extend((q, x) for q in kept for x in sorted(self.goes[q]) if self.goes[q][x] not in known and (q, x) not in edge)
                    break
            else:
                kept.append(state)
                known.add(state)
                edge.extend((state, x) for x in sorted(self.goes[state]))
        self.kept = kept

    def _compile(self) -> None:
        number = {s: i for i, s in enumerate(self.kept)}
        n = len(self.kept)
        self.next = np.zeros((n, self.symbols), np.int64)
        self.log_symbol, self.log_end = np.zeros((n, self.symbols)), np.zeros(n)
        for s, i in number.items():
            whole = self.passed[s] + 0.5 * (self.symbols + 1)
            self.log_symbol[i] = np.log(0.5 / whole)
            for c, m in self.count[s].items():
                self.next[i, c] = number[self.goes[s][c]]
                self.log_symbol[i, c] = np.log((m + 0.5) / whole)
            self.log_end[i] = np.log((self.ended[s] + 0.5) / whole)
        del self.passed, self.ended, self.goes, self.count, self.kept

    def scores(self, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Log likelihoods of strings given as one array: all move one symbol at a time."""
        total, state = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1, np.int64)
        for live, c in self._steps(symbols, offsets, state):
            total[live] += self.log_symbol[state[live], c]
        return total + self.log_end[state]

    def visits(self, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per state, how often the strings go on by each symbol, and in the last column how often they end in it."""
        found, state = np.zeros((len(self.next), self.symbols + 1), np.int64), np.zeros(len(offsets) - 1, np.int64)
        for live, c in self._steps(symbols, offsets, state):
            np.add.at(found, (state[live], c), 1)
        np.add.at(found, (state, self.symbols), 1)
        return found

    def recount(self, visits: np.ndarray) -> None:
        """Take probabilities from these counts; the states stay."""
        shares = np.log((visits + 0.5) / (visits.sum(1, keepdims=True) + 0.5 * (self.symbols + 1)))
        self.log_symbol, self.log_end = np.ascontiguousarray(shares[:, :-1]), shares[:, -1].copy()

    def _steps(self, symbols: np.ndarray, offsets: np.ndarray, state: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Strings that have a next symbol, and that symbol, until all have ended; then moves their ``state`` on."""
        starts, sizes = offsets[:-1], np.diff(offsets)
        live = np.argsort(-sizes, kind="stable")
        for i in range(int(sizes.max()) if len(sizes) else 0):
            live = live[: np.searchsorted(-sizes[live], -i, "left")]
            c = symbols[starts[live] + i]
            yield live, c
            state[live] = self.next[state[live], c]
