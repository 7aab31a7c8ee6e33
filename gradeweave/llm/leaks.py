"""Benchmark decontamination: test phrases searched backward in an FM-index of each training shard.

A shard is one batch of documents inside a task. Of its words the index holds the stretches in
which every pair of neighbours also stands in the benchmark: no phrase can occur anywhere else.
Phrases are searched by wavelet ranks, located by sampled suffix positions, and merged into spans.

The benchmark comes to the driver in slices of about ``SLICE_BYTES`` of text (or one item). A benchmark of
one slice is one pass over the documents. With more, documents are stored with a row number and read
once per slice; the rows that a slice hits are written before its broadcast is destroyed and the next
one is made, so a single slice is in memory at any time. Spans of all slices are merged at the end.

Defined cases: null texts have no words; items without words have no windows; a null item_id
counts as the empty string, and an id given twice counts once; equal documents get equal rows;
without a benchmark nothing is hit; other columns are ignored, or passed on by ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeweave.llm.fmindex import FMIndex
from gradeweave.llm.textnum import LOWER, blocks, mix64, range_hashes, runs, utf8
from gradeweave.sources.shared import stage

WINDOW = 10
SLICE_BYTES = 4 << 20
_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True
FOUND = "n_words bigint, span_starts array<bigint>, span_ends array<bigint>, items array<string>"


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and each document's first word."""
    data = LOWER[data]
    starts, ends = runs(_IN_WORD[data], offsets)
    return range_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def _pairs(words: np.ndarray) -> np.ndarray:
    return mix64(words[:-1] * np.uint64(3) + words[1:])


def _in(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


@dataclass
class Phrases:
    """Distinct windows by length, with the items that have them (window k: ids[first[k]:first[k + 1]])."""

    windows: dict[int, np.ndarray]
    first: dict[int, np.ndarray]
    items: dict[int, np.ndarray]
    ids: list[str]
    vocabulary: np.ndarray
    pairs: np.ndarray

    @classmethod
    def of(cls, ids: list[str], texts: pa.Array) -> Phrases:
        data, offsets = utf8(texts)
        words, first_word = word_hashes(data, offsets)
        names = sorted(set(ids))
        number = {x: i for i, x in enumerate(names)}
        rows: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[np.ndarray]] = {}
        for name, a, b in zip(ids, first_word, first_word[1:]):
            if b > a:
                width = min(WINDOW, b - a)
                found = np.lib.stride_tricks.sliding_window_view(words[a:b], width)
                rows.setdefault(width, []).append(found)
                owners.setdefault(width, []).append(np.full(len(found), number[name]))
        windows, first, items = {}, {}, {}
        for width in rows:
            kinds, which = np.unique(np.concatenate(rows[width]), axis=0, return_inverse=True)
            owned = np.unique(np.column_stack([which.ravel(), np.concatenate(owners[width])]), axis=0)
            windows[width], items[width] = kinds, owned[:, 1]
            first[width] = np.searchsorted(owned[:, 0], np.arange(len(kinds) + 1))
        inside = np.ones(max(0, len(words) - 1), bool)
        inside[first_word[1:-1][(first_word[1:-1] > 0) & (first_word[1:-1] < len(words))] - 1] = False
        return cls(windows, first, items, names, np.unique(words), np.unique(_pairs(words)[inside]))

    def occurrences(self, words: np.ndarray, first_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All places of windows in a shard: position, length, and (document, item) pairs."""
        none = np.zeros(0, np.int64)
        if not self.windows or not len(words):
            return none, none, none, none
        least = min(self.windows)
        known = _in(self.vocabulary, words)
        linked = np.zeros(len(words), bool)  # to the word before, in one document
        both = np.flatnonzero(known[1:] & known[:-1])
        linked[both[_in(self.pairs, mix64(words[both] * np.uint64(3) + words[both + 1]))] + 1] = True
        linked[first_word[:-1][first_word[:-1] < len(words)]] = False
        begins = np.flatnonzero(known & ~linked)
        stretch = np.cumsum(known & ~linked) - 1
        sizes = np.bincount(stretch[known], minlength=len(begins)) if len(begins) else none
        used = np.flatnonzero(known)
        used = used[sizes[stretch[used]] >= least]
        if not len(used):
            return none, none, none, none
        # one sequence: stretches with separators (1) between, and the end (0)
        kinds, ids = np.unique(words[used], return_inverse=True)
        number = np.cumsum(np.concatenate([[0], stretch[used][1:] != stretch[used][:-1]]))
        place = np.arange(len(used)) + number
        text = np.ones(place[-1] + 2, np.int64)
        text[place] = ids + 2
        text[-1] = 0
        index = FMIndex(text, len(kinds) + 2)
        source = np.full(len(text), -1, np.int64)
        source[place] = used
        here = np.unique(_pairs(words[used])) if len(used) > 1 else np.zeros(0, np.uint64)
        at, width_of, owner, item = [none], [none], [none], [none]
        for width, windows in self.windows.items():
            can = _in(kinds, windows[:, 0])
            for i in range(1, width):
                can[can] = _in(here, mix64(windows[can, i - 1] * np.uint64(3) + windows[can, i]))
            can = np.flatnonzero(can)
            phrases = np.searchsorted(kinds, windows[can]) + 2
            low, high = index.search(phrases)
            count = high - low
            rows = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]) if len(low) else none, count) + np.arange(count.sum())
            positions = source[index.locate(rows)]
            which = np.repeat(can, count)
            at.append(positions)
            width_of.append(np.full(len(positions), width))
            doc = np.searchsorted(first_word, positions, "right") - 1
            pairs = np.unique(np.column_stack([doc, which]), axis=0)
            many = self.first[width][pairs[:, 1] + 1] - self.first[width][pairs[:, 1]]
            owner.append(np.repeat(pairs[:, 0], many))
            begin = self.first[width][pairs[:, 1]]
            item.append(self.items[width][np.repeat(begin - np.concatenate([[0], np.cumsum(many)[:-1]]) if len(many) else none, many)
                                          + np.arange(many.sum())])
        return tuple(np.concatenate(x).astype(np.int64) for x in (at, width_of, owner, item))


def _spans(n: int, at: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merged spans of hit words among n."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + widths, -1)
    hit = np.concatenate([[False], np.cumsum(step)[:n] > 0, [False]]).astype(np.int8)
    edge = np.diff(hit)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _slices(benchmark: DataFrame) -> tuple[int, Iterator[Phrases]]:
    """How many slices there are, and the slices one by one."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text")
    total = items.agg(F.coalesce(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + F.octet_length("id")), F.lit(0))).first()[0]
    n = max(1, -(-2 * total // SLICE_BYTES)) if total > SLICE_BYTES else 1

    def read() -> Iterator[Phrases]:
        for k in range(n):  # one slice at a time is in the driver
            part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).toArrow() if n > 1 else items.toArrow()
            yield Phrases.of(part.column("id").to_pylist(), part.column("text").combine_chunks())

    return n, read()


def found(docs: DataFrame, benchmark: DataFrame, text: str) -> DataFrame:
    """``docs`` with n_words, the merged word spans that are hit, and the items that occur (as lists).

    Columns of ``docs`` go through as they are, named _0, _1, ...
    """
    kept = docs.columns
    held = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(kept)])
    fields = ", ".join(f"_{i} {held.schema[i].dataType.simpleString()}" for i in range(len(kept)))
    text = F.col(f"_{kept.index(text)}").alias("_text")
    context = docs.sparkSession.sparkContext
    n, slices = _slices(benchmark)
    if n == 1:
        return held.select("*", text).mapInArrow(_finder(context.broadcast(next(slices)), len(kept)), f"{fields}, {FOUND}")
    held = stage(held.withColumn("_rid", F.monotonically_increasing_id()), "leaks-documents")
    hits = []
    for phrases in slices:
        shared = context.broadcast(phrases)
        # the first slice gives the words of all rows, the others only rows that they hit
        hit = held.select("_rid", text).mapInArrow(_finder(shared, 1, only_hits=bool(hits)), f"_rid bigint, {FOUND}")
        hits.append(stage(hit, "leaks-hits"))
        shared.destroy()
    lists = [c.split()[0] for c in FOUND.split(", ")[1:]]
    together = reduce(DataFrame.unionByName, hits).groupBy("_rid").agg(
        F.max("n_words").alias("n_words"), *[F.flatten(F.collect_list(c)).alias(c) for c in lists])
    return held.join(together.mapInArrow(_merged, f"_rid bigint, {FOUND}"), "_rid").drop("_rid")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the spans and items of several slices, each list merged."""
    for batch in batches:
        rid, n_words, begins, ends, items = batch.columns
        spans = []
        for n, a, b in zip(n_words.to_pylist(), begins.to_pylist(), ends.to_pylist()):
            at = np.array(a, np.int64)
            spans.append([x.tolist() for x in _spans(n, at, np.array(b, np.int64) - at)])
        yield pa.RecordBatch.from_arrays(
            [rid, n_words, *[pa.array([x[i] for x in spans], pa.list_(pa.int64())) for i in range(2)],
             pa.array([sorted(set(x)) for x in items.to_pylist()], pa.list_(pa.string()))], names=batch.schema.names)


def _finder(shared, n_kept: int, only_hits: bool = False):
    """The first ``n_kept`` columns, and what one slice finds in the rows' texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        for batch in batches:
            if not len(batch):
                continue
            parts = [word_hashes(data, offsets) for _, data, offsets in blocks(iter([batch]), "_text")]
            words = np.concatenate([w for w, _ in parts])
            counts = np.concatenate([np.diff(f) for _, f in parts])
            first_word = np.concatenate([[0], np.cumsum(counts)])
            at, widths, owner, item = phrases.occurrences(words, first_word)
            starts, ends = _spans_by_document(len(words), at, widths, first_word)
            mine: dict[int, set[str]] = {}
            for d, i in zip(owner.tolist(), item.tolist()):
                mine.setdefault(d, set()).add(phrases.ids[i])
            items = [sorted(mine.get(d, ())) for d in range(len(batch))]
            cut = np.searchsorted(starts, first_word)
            lists = [[(x[a:b] - w).tolist() for a, b, w in zip(cut, cut[1:], first_word)] for x in (starts, ends)]
            out = pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(n_kept)], pa.array(counts.astype(np.int64)), *[pa.array(x, pa.list_(pa.int64())) for x in lists],
                 pa.array(items, pa.list_(pa.string()))],
                names=[*batch.schema.names[:n_kept], "n_words", "span_starts", "span_ends", "items"])
            yield out.filter(pa.array(np.diff(cut) > 0)) if only_hits else out

    return run


def _spans_by_document(n: int, at: np.ndarray, widths: np.ndarray, first_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans cut where a new document begins."""
    starts, ends = _spans(n, at, widths)
    borders = first_word[1:-1]
    k = np.searchsorted(starts, borders, "right") - 1
    inside = borders[(k >= 0) & (starts[k] < borders) & (ends[k] > borders)] if len(starts) else borders[:0]
    inside = np.unique(inside)
    return np.sort(np.concatenate([starts, inside])), np.sort(np.concatenate([ends, inside]))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hits = found(docs.select("doc_id", "text"), benchmark, "text")
    n_hit = F.aggregate(F.zip_with("span_ends", "span_starts", lambda b, a: b - a), F.lit(0).cast("bigint"), lambda s, x: s + x)
    return hits.select(
        F.col("_0").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs."""
    return found(docs, benchmark, "text").where(F.size("span_starts") == 0).drop("n_words", "span_starts", "span_ends", "items").toDF(*docs.columns)


SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS phrase
  FROM b, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS u(p) WHERE len(w) > 0),
dw AS (
  SELECT rid, p, n, array_to_string(w[p:p + n - 1], ' ') AS phrase
  FROM d, (SELECT DISTINCT n FROM bw), unnest(generate_series(1, len(w) - n + 1)) AS u(p)),
hit AS (SELECT DISTINCT rid, p, dw.n, item FROM dw JOIN bw ON dw.n = bw.n AND dw.phrase = bw.phrase),
covered AS (SELECT rid, count(DISTINCT q) AS n_hit FROM hit, unnest(generate_series(p, p + n - 1)) AS u(q) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN items USING (rid)
"""
