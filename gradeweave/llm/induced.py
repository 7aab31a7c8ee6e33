"""Suffix sorting of one shard by external induced sorting, with common prefixes up to a limit.

The text of a shard is a file of symbols. Suffixes at local minima are sorted first: their
substrings are named, and the string of names is sorted by the same method (in memory once it is
short enough). All other suffixes are induced from them, first those that descend, symbol by
symbol upwards, then those that ascend, downwards. What waits to be extracted stands in queues:
by symbol and, in one symbol, in order of arrival, which is the order of the suffixes. A
queue entry is a suffix with the prefix it shares with the entry before it; entries beyond
``Disk.memory`` go to files. The common prefix of two entries is one more than the least one
between the suffixes that induced them.

Common prefixes are cut at ``limit``, and suffixes that agree that far stand together in any order.
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Iterator

import numpy as np

from gradeweave.llm.fmindex import carried, run_starts, suffix_order

BLOCK = 1 << 18
#: Names sorted in memory; more of them are sorted by another round of induction.
BASE = 1 << 22


class Disk:
    """Scratch files of one shard and the memory that its queues may hold before they use them."""

    def __init__(self, folder: str, memory: int = 64 << 20):
        self.folder, self.memory, self.held, self.files = folder, memory, 0, 0

    def path(self) -> str:
        self.files += 1
        return os.path.join(self.folder, str(self.files))

    def array(self, length: int, dtype) -> np.ndarray:
        return np.memmap(self.path(), dtype, "w+", shape=(length,)) if length else np.zeros(0, dtype)


class Queue:
    """Entries (suffix, common prefix) in order of arrival; blocks beyond the memory are on disk."""

    def __init__(self, disk: Disk):
        self.disk, self.blocks = disk, deque()

    def put(self, at: np.ndarray, common: np.ndarray) -> None:
        for i in range(0, len(at), BLOCK):
            a, c = at[i : i + BLOCK], common[i : i + BLOCK]
            size = a.nbytes + c.nbytes
            if self.disk.held + size > self.disk.memory:
                path = self.disk.path()
                np.savez(path, a=a, c=c)
                self.blocks.append(path + ".npz")
            else:
                self.disk.held += size
                self.blocks.append((a, c))

    def _load(self, block) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(block, str):
            with np.load(block) as f:
                out = f["a"], f["c"]
            os.remove(block)
            return out
        self.disk.held -= block[0].nbytes + block[1].nbytes
        return block

    def take(self) -> tuple[np.ndarray, np.ndarray] | None:
        """The oldest entries, a block or so of them."""
        if not self.blocks:
            return None
        got = [self._load(self.blocks.popleft())]
        many = len(got[0][0])
        while self.blocks and many < BLOCK // 4:
            got.append(self._load(self.blocks.popleft()))
            many += len(got[-1][0])
        return tuple(np.concatenate(x) for x in zip(*got)) if len(got) > 1 else got[0]

    def take_last(self) -> tuple[np.ndarray, np.ndarray] | None:
        return self._load(self.blocks.pop()) if self.blocks else None


def _minima(text: np.ndarray, disk: Disk) -> np.ndarray:
    """Places where a descent ends and an ascent begins, the last symbol among them."""
    n, found, rising, after = len(text), [], True, int(text[-1])
    for high in range(n - 1, 0, -BLOCK):  # block covers [low, high); the symbol at high is known
        low = max(0, high - BLOCK)
        part = np.append(np.asarray(text[low:high]).astype(np.int64), after)
        step = np.sign(np.diff(part))
        kept = np.where(step != 0, np.arange(len(step)), len(step))
        nearest = np.minimum.accumulate(kept[::-1])[::-1]
        up = np.append(step, 1 if rising else -1)[nearest] > 0
        up = np.append(up, rising)
        places = np.flatnonzero(up[1:] & ~up[:-1]) + 1 + low
        found.append(places[::-1])
        rising, after = bool(up[0]), int(part[0])
    every = np.concatenate(found)[::-1] if found else np.zeros(0, np.int64)
    out = disk.array(len(every), np.int64)
    out[:] = every
    return out


def _word(text: np.ndarray, at: np.ndarray, many: np.ndarray) -> np.ndarray:
    """``many`` (up to 8 bytes, or one larger symbol) from ``at`` as one number, high values after the end."""
    if text.dtype != np.uint8:
        return np.where(many > 0, text[np.minimum(at, len(text) - 1)].astype(np.uint64), np.uint64(2**64 - 1))
    if len(text) < 8:
        text = np.append(text, np.zeros(8, np.uint8))
    last = len(text) - 8
    words = np.lib.stride_tricks.sliding_window_view(text, 8)[np.minimum(at, last)].view(">u8").ravel().astype(np.uint64)
    words <<= (8 * np.maximum(at - last, 0)).astype(np.uint64)
    return words | _AFTER[np.minimum(many, 8)]


_AFTER = np.array([(1 << 64 - 8 * i) - 1 for i in range(9)], np.uint64)


def _names(text: np.ndarray, minima: np.ndarray, limit: int) -> np.ndarray:
    """Ranks of the substrings from one minimum to the next: equal substrings, equal rank.

    If one is the beginning of another, the longer descends where the shorter turns, and is smaller.
    """
    size = np.minimum(np.diff(np.append(minima, len(text) - 1)) + 1, limit)
    width = 8 if text.dtype == np.uint8 else 1
    word = _word(text, np.asarray(minima), size)
    order = np.argsort(word)
    rank = run_starts(word[order])
    name = np.empty(len(order), np.int64)
    name[order] = rank
    done = width
    while True:
        longer = size > done
        if not longer.any():
            return name
        open_rank = np.zeros(len(name) + 1, bool)
        open_rank[name[longer]] = True
        part = np.flatnonzero(open_rank[name])
        word = _word(text, np.asarray(minima)[part] + done, size[part] - done)
        order = part[np.lexsort((word, name[part]))]
        back = np.empty(len(name), np.int64)
        back[part] = np.arange(len(part))
        w, r = word[back[order]], name[order]
        new = np.ones(len(order), bool)
        new[1:] = (w[1:] != w[:-1]) | (r[1:] != r[:-1])
        group = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        inside = np.arange(len(order)) - np.repeat(group, np.diff(np.append(group, len(order))))
        name[order] = r + carried(np.where(new, inside, -1))
        done += width


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Lengths of common prefixes of suffixes, up to ``limit``."""
    out = np.zeros(len(a), np.int64)
    live, n = np.arange(len(a)), len(text)
    for done in range(0, limit, 8):
        if not len(live):
            break
        x, y = a[live] + done, b[live] + done
        if text.dtype == np.uint8 and max(int(x.max()), int(y.max())) + 8 <= n:
            words = np.ndarray(n - 7, "<u8", np.asarray(text), strides=(1,))  # the eight bytes from each place, the first of them lowest
            apart = words[x] ^ words[y]
            alike = apart == 0
            out[live[alike]] += 8
            apart = apart[~alike]
            out[live[~alike]] += np.bitwise_count((apart & (~apart + np.uint64(1))) - np.uint64(1)) >> 3  # whole bytes below the lowest bit
            live = live[alike]
            continue
        same, going = np.zeros(len(live), np.int64), np.ones(len(live), bool)
        for i in range(8):
            p, q = x + i, y + i
            going = going & (np.maximum(p, q) < n)
            going = going & (text[np.minimum(p, n - 1)] == text[np.minimum(q, n - 1)])
            same += going
        out[live] += same
        live = live[same == 8]
    return np.minimum(out, limit)


class _Gaps:
    """Least common prefix since the last entry of each symbol's queue."""

    def __init__(self, symbols: int, limit: int):
        self.least, self.fresh, self.limit = np.full(symbols, 255, np.uint8), np.ones(symbols, bool), limit

    def pushed(self, common: np.ndarray, index: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Common prefixes of new entries: those at ``index`` of a block, sorted by symbol and place."""
        whole = common.min()
        if not len(index):
            np.minimum(self.least, whole, out=self.least)
            return np.zeros(0, np.uint8)
        first = np.ones(len(index), bool)
        first[1:] = symbol[1:] != symbol[:-1]
        begin = np.where(first, 0, np.append(0, index[:-1] + 1))
        padded = np.append(common, np.uint8(255))
        low = np.minimum.reduceat(padded, np.column_stack([begin, index + 1]).ravel())[::2]
        heads = symbol[first]
        low[first] = np.minimum(low[first], self.least[heads])
        out = np.minimum(low.astype(np.int64) + 1, self.limit).astype(np.uint8)
        new = np.flatnonzero(first)[self.fresh[heads]]
        out[new] = 0
        last = index[np.append(np.flatnonzero(first)[1:] - 1, len(index) - 1)]
        tail = np.minimum.accumulate(padded[::-1])[::-1]
        np.minimum(self.least, whole, out=self.least)
        self.least[heads] = tail[last + 1]
        self.fresh[heads] = False
        return out


def induce(text: np.ndarray, seeds: np.ndarray, disk: Disk, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes but the last, from the greatest down, each with what it shares with the one before; from sorted minima.

    ``limit`` 0: order only.
    """
    with_common = limit > 0
    symbols = int(text.max()) + 1
    queues: dict[int, Queue] = {}
    kept: dict[int, Queue] = {}
    seed_symbol = text[seeds]
    cut = np.flatnonzero(np.concatenate([[True], seed_symbol[1:] != seed_symbol[:-1], [True]]))
    seed_range = {int(seed_symbol[a]): (a, b) for a, b in zip(cut, cut[1:])}
    gaps = _Gaps(symbols if with_common else 1, limit)
    present = np.unique(text) if with_common or len(text) < BLOCK else np.flatnonzero(np.bincount(text, minlength=symbols))

    def push(at: np.ndarray, common: np.ndarray, allowed) -> None:
        before = text[np.maximum(at - 1, 0)]
        index = np.flatnonzero(allowed(before) & (at > 0))
        symbol = before[index]
        order = np.argsort(symbol, kind="stable")  # of bytes: by counting
        index, symbol = index[order], symbol[order]
        shared = gaps.pushed(common, index, symbol) if with_common else np.zeros(len(index), np.uint8)
        if len(index):
            edge = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1], [True]]))
            for a, b in zip(edge, edge[1:]):
                queues.setdefault(int(symbol[a]), Queue(disk)).put(at[index[a:b]] - 1, shared[a:b])

    def drained(c: int, allowed) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The queue of a symbol, entries that it gets meanwhile included."""
        depth = 0
        while c in queues and (block := queues[c].take()) is not None:
            if with_common and depth >= limit and (block[1] >= limit).all() and _all_runs(text, c, block[0], limit):
                # long runs of one symbol: all that follows agrees as far as the limit, and may stand in any order
                block = _unrolled(text, c, *block, limit)
                push(*block, lambda x: allowed(x) & (x != c))
            else:
                push(*block, allowed)
            depth += 1
            yield block
        queues.pop(c, None)

    seam = lambda a, b: np.uint8(common_prefix(text, np.array([a]), np.array([b]), limit)[0] if with_common else 0)
    for c in present:
        c = int(c)
        last = None
        kept[c] = Queue(disk)
        for at, common in drained(c, lambda x: x >= c):  # noqa: B023
            kept[c].put(at, common)
            last = at[-1]
        if c in seed_range:
            a, b = seed_range[c]
            for i in range(a, b, BLOCK):
                at = np.asarray(seeds[i : min(b, i + BLOCK)])
                common = np.zeros(len(at), np.uint8)
                if with_common:
                    earlier = np.append(seeds[i - 1] if i > a else at[0], at[:-1])
                    common = common_prefix(text, earlier, at, limit).astype(np.uint8)
                    if i == a:
                        common[0] = seam(last, at[0]) if last is not None else 0
                push(at, common, lambda x: x >= c)  # noqa: B023
    queues.clear()
    gaps = _Gaps(symbols if with_common else 1, limit)
    for c in present[::-1]:
        c = int(c)
        last = None
        for block in drained(c, lambda x: x <= c):  # noqa: B023
            last = block[0][-1]
            yield block
        carried = None
        while (block := kept[c].take_last()) is not None:
            at = block[0][::-1]
            first = carried if carried is not None else seam(at[0], last) if last is not None else 0
            common = np.append(np.uint8(first), block[1][:0:-1]).astype(np.uint8)
            carried = block[1][0]
            push(at, common, lambda x: x < c)  # noqa: B023
            yield at, common


def _all_runs(text: np.ndarray, c: int, at: np.ndarray, limit: int) -> bool:
    """Whether all these suffixes begin with ``limit`` times the symbol."""
    return int(at.max()) + limit <= len(text) and all((text[at + i] == c).all() for i in range(limit))


def _unrolled(text: np.ndarray, c: int, at: np.ndarray, common: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries with all that precede them in their runs of one symbol, as the queue would bring them."""
    runs = np.zeros(len(at), np.int64)
    live, step = np.arange(len(at)), 1
    while len(live):  # steps of growing length along the runs
        x = at[live] - runs[live]
        reach = np.minimum(x, step)
        same = np.zeros(len(live), np.int64)
        for k, (p, r) in enumerate(zip(x, reach)):
            piece = np.asarray(text[p - r : p])[::-1] == c
            same[k] = r if piece.all() else piece.argmin()
        runs[live] += same
        live, step = live[(same == reach) & (reach > 0)], min(step * 2, BLOCK)
    level = np.arange(runs.sum() + len(at)) - np.repeat(np.cumsum(runs + 1) - runs - 1, runs + 1)
    entry = np.repeat(np.arange(len(at)), runs + 1)
    order = np.lexsort((entry, level))
    return at[entry[order]] - level[order], np.full(len(order), limit, np.uint8)


def sorted_minima(text: np.ndarray, disk: Disk, limit: int) -> np.ndarray:
    """Suffixes at minima in their order (as far as ``limit`` symbols tell them apart)."""
    minima = _minima(text, disk)
    name = _names(text, minima, max(limit, 2))
    if len(name) <= BASE:
        kinds, small = np.unique(name, return_inverse=True)
        if len(kinds) == len(name):
            return np.asarray(minima)[np.argsort(name)]
        return np.asarray(minima)[suffix_order(small, limit // 2 + 1)]  # a name stands for two symbols or more
    _, small = np.unique(name, return_inverse=True)
    again = disk.array(len(small) + 1, np.int64)
    again[:-1], again[-1] = small + 1, 0
    inner = sorted_minima(again, disk, limit)
    order = np.concatenate([at for at, _ in induce(again, inner, disk, 0)])[::-1]
    return np.asarray(minima)[order]


def sorted_suffixes(text: np.ndarray, disk: Disk, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes of a text whose last symbol is 0, there only, in descending order, with common prefixes."""
    yield from induce(text, sorted_minima(text, disk, limit), disk, limit)
