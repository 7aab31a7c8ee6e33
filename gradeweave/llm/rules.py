"""Quality rules learned as gradient-boosted trees over document statistics.

Statistics are counted on whole texts, a block of documents at a time. Trees are fitted in numpy
on a bounded sample of labelled documents (about ``SAMPLE_ROWS``, by hash of doc_id): histogram
splits on logistic loss, and for the features in ``DIRECTIONS`` a verdict that can only move one
way (more symbols, repeated lines or repeated words never make a text better). Each tree is one
array of nodes, and scoring moves all documents down one level at a time.

Defined cases: null text has no words and fails the base rules; labels without doc_id or quality
are ignored, and a document labelled more than once counts as its worst label; without labels of
both kinds the base rules decide alone; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeweave.llm.textnum import (IS_WHITE, LOWER, blocks, byte_set, counts_per_document, mix64, range_hashes, runs,
                                    window_hashes, windows_inside)

SAMPLE_ROWS = 20_000
WINDOW = 5
TREES, DEPTH, BINS, RATE, L2, MIN_ROWS = 60, 3, 64, 0.25, 1.0, 5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
            "digit_share", "upper_share", "punct_share", "line_words", "same_word_share"]
# 1: a larger value never lowers the verdict, -1: never raises it.
DIRECTIONS = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "same_word_share": -1}

_SYMBOL, _DIGIT = byte_set(b"#*$%&|<>"), byte_set(b"0123456789")
_UPPER, _PUNCT = byte_set(bytes(range(65, 91))), byte_set(b".,;:!?")
_FIRST = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a character


def _per(sums: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(sums, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each hash: whether its owner has it again, and whether it is not the first of its kind there."""
    key = mix64(owner.astype(np.uint64) + np.uint64(1)) ^ hashes
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    again = ~new
    shared = again.copy()
    shared[:-1] |= again[1:]
    out = np.zeros((2, len(key)), bool)
    out[0, order], out[1, order] = shared, again
    return out[0], out[1]


def statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The counts of ``COUNTS`` per document, and the features as a matrix."""
    n = len(offsets) - 1
    white = IS_WHITE[data]
    starts, ends = runs(~white, offsets)
    first_word = np.searchsorted(starts, offsets)
    n_words = np.diff(first_word)
    owner = np.repeat(np.arange(n), n_words)
    words = range_hashes(data, starts, ends)

    windows = window_hashes(words, WINDOW)
    at = np.flatnonzero(windows_inside(first_word, WINDOW))
    found, _ = _repeats(owner[at], windows[at])
    step = np.zeros(len(words) + 1, np.int64)
    hit = at[found]
    np.add.at(step, hit, 1)
    np.add.at(step, hit + WINDOW, -1)
    n_repeat = np.bincount(owner[np.cumsum(step[:-1]) > 0], minlength=n)

    line_starts, line_ends = runs(data != 10, offsets)
    has_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[has_word], line_ends[has_word]
    n_lines = counts_per_document(line_starts, offsets)
    _, again = _repeats(np.repeat(np.arange(n), n_lines), range_hashes(data, line_starts, line_ends))
    n_dup = np.bincount(np.repeat(np.arange(n), n_lines)[again], minlength=n)

    _, known = _repeats(owner, range_hashes(LOWER[data], starts, ends))
    follows = np.zeros(len(words), bool)
    if len(words):
        follows[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    count = lambda table: _per(table[data], offsets)
    word_chars = _per(_FIRST[data] & ~white, offsets)
    counts = dict(zip(COUNTS, (n_words, word_chars, count(_SYMBOL), n_dup, n_repeat)))
    over = lambda a, b: a / np.maximum(b, 1)
    features = np.column_stack([
        np.log1p(n_words), over(word_chars, n_words), over(counts["n_symbols"], word_chars), over(n_dup, n_lines), over(n_repeat, n_words),
        over(n_words - np.bincount(owner[known], minlength=n), n_words), over(count(_DIGIT), word_chars), over(count(_UPPER), word_chars),
        over(count(_PUNCT), word_chars), over(n_words, n_lines), over(np.bincount(owner[follows], minlength=n), n_words)])
    return counts, features


@dataclass
class Trees:
    """All trees as arrays (tree, node): feature (-1: leaf), split value, value; children of node i are 2i+1 and 2i+2."""

    feature: np.ndarray
    split: np.ndarray
    value: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, split, value in zip(self.feature, self.split, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = feature[node]
                down = 2 * node + 1 + (x[rows, f] > split[node])
                node = np.where(f >= 0, down, node)
            total += value[node]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, directions: list[int]) -> Trees:
    """Boosted trees for P(y = 1); split points are quantiles of the sample."""
    nodes = 2 ** (DEPTH + 1) - 1
    feature = np.full((TREES, nodes), -1)
    split, value = np.zeros((TREES, nodes)), np.zeros((TREES, nodes))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])
    mean = y.mean()
    total = np.full(len(y), base := float(np.log(mean / (1 - mean))))
    for t in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        work = [(0, np.arange(len(y)), -np.inf, np.inf)]
        while work:
            node, rows, low, high = work.pop()
            worth = lambda a, b: np.clip(a / (b + L2), low, high)  # noqa: B023, E731
            value[t, node] = RATE * worth(g[rows].sum(), h[rows].sum())
            total[rows] += value[t, node] if 2 * node + 1 >= nodes else 0
            best = (1e-6, None)
            gain = lambda w, a, b: w * a - 0.5 * w * w * (b + L2)
            here = gain(worth(g[rows].sum(), h[rows].sum()), g[rows].sum(), h[rows].sum())
            for f in range(x.shape[1]) if 2 * node + 1 < nodes else ():
                size = len(cuts[f]) + 1
                sums = [np.cumsum(np.bincount(bins[rows, f], w, size))[:-1] for w in (g[rows], h[rows], None)]
                gl, hl, nl = sums
                if not len(gl):
                    continue
                gr, hr = g[rows].sum() - gl, h[rows].sum() - hl
                wl, wr = worth(gl, hl), worth(gr, hr)
                better = gain(wl, gl, hl) + gain(wr, gr, hr) - here
                better[(nl < MIN_ROWS) | (len(rows) - nl < MIN_ROWS) | ((wr - wl) * directions[f] < 0)] = -1
                k = int(better.argmax())
                if better[k] > best[0]:
                    best = (better[k], (f, k, float(wl[k] + wr[k]) / 2))
            if best[1] is None:
                if 2 * node + 1 < nodes:
                    total[rows] += value[t, node]
                continue
            f, k, middle = best[1]
            feature[t, node], split[t, node] = f, cuts[f][k]
            left = bins[rows, f] <= k
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[directions[f]]
            work += [(2 * node + 1, rows[left], *bounds[0]), (2 * node + 2, rows[~left], *bounds[1])]
    return Trees(feature, split, value, base)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in blocks(batches):
        _, x = statistics(data, offsets)
        yield pa.RecordBatch.from_arrays([batch.column(1), *[pa.array(c) for c in x.T]], names=["good", *FEATURES])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Trees | None:
    """Fit on about ``sample`` labelled documents; only their features come to the driver."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    part = min(1.0, sample / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < int(part * (1 << 30)))
    worst = known.groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("good"))
    texts = docs.select("doc_id", "text").join(worst, "doc_id").select("text", "good")
    rows = texts.mapInArrow(_features, "good int, " + ", ".join(f"{f} double" for f in FEATURES)).toPandas()
    rows = rows.sort_values(list(rows.columns))
    y = (rows["good"].to_numpy() > 0).astype(float)
    if not len(y) or y.min() == y.max():
        return None
    return fit(rows[FEATURES].to_numpy(float), y, [DIRECTIONS.get(f, 0) for f in FEATURES])


def judged(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and score (chance of good quality; null without trees)."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch, data, offsets in blocks(batches):
            counts, x = statistics(data, offsets)
            failed = (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])
            score = trees.scores(x) if trees else None
            kept = ~failed & (score >= 0.5) if trees else ~failed
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c.astype(np.int64)) for c in counts.values()], pa.array(failed), pa.array(kept),
                 pa.array(score) if trees else pa.nulls(len(batch), pa.float64())],
                names=["doc_id", *COUNTS, "base_failed", "kept", "score"])

    held = docs.select("doc_id", "text")
    kind = held.schema["doc_id"].dataType.simpleString()
    return held.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, kept boolean, score double")


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judged(docs, train(docs, labels))
