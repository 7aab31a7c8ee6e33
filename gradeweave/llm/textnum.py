"""Arrow text columns as numpy arrays: bytes, words and word hashes of whole blocks of documents.

Inside a task a batch of documents is one byte array plus the offsets of the documents in it.
Everything here works on such arrays at once, so Python runs a few calls per block, not per word.
Blocks hold about ``BLOCK_BYTES`` of text, or one document if that is longer: a task needs memory
in proportion to that, not to its partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def byte_set(members: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(members)] = True
    return found


IS_WHITE = byte_set(WHITE)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[tuple]:
    """Slices of the batches with at most ``limit`` bytes of text, or one row: (slice, bytes, offsets). Null is empty."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        data, offsets = utf8(column)
        first = 0
        while first < len(batch):
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), len(batch))
            lo, hi = offsets[first], offsets[last]
            yield batch.slice(first, last - first), data[lo:hi], offsets[first : last + 1] - lo
            first = last


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and where each row starts in them (one more than rows)."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of True that cross no document border."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    borders = offsets[:-1][offsets[:-1] < len(inside)]
    before = np.empty(len(inside), bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[borders] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(inside), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[borders[borders > 0] - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def counts_per_document(places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the sorted places lie in each document."""
    return np.diff(np.searchsorted(places, offsets, "left"))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i up to n."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n + 1, BLOCK_BYTES + 64)
        with np.errstate(over="ignore"):
            _POWERS[:] = [np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, np.uint64(b), np.uint64)]))
                          for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


_BASE = 0xD6E8FEB86659FD93
_BYTE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges: equal bytes, equal hash."""
    up, down = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _ODD)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of ``width`` consecutive word hashes; one per place where a window fits in the array."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total = (total + words[i : i + n]) * np.uint64(_BASE)
    return mix64(total)


def windows_inside(first_word: np.ndarray, width: int) -> np.ndarray:
    """Of all places for a window, those where it stays in one document; first_word: each document's first word, and the end."""
    n = int(first_word[-1]) - width + 1
    if n <= 0:
        return np.zeros(0, bool)
    fits = np.ones(n, bool)
    for back in range(1, width):
        at = first_word[1:-1] - back
        fits[at[(at >= 0) & (at < n)]] = False
    return fits
