"""Suffix-array dedup: bytes covered by long strings that also start elsewhere, removed from every document.

Shards are made by content, so that equal strings meet in one of them. Each string of ``LENGTH``
bytes is named by the least hash among its substrings of ``GRAM`` bytes; neighbouring starts mostly
have the same name, and form one stretch. Stretches whose name comes only once in all documents
hold no repeat. The others are gathered by name into shards, equal stretches once with the number
of copies, as many shards as their bytes need, and each shard is sorted by external induced sorting (``induced``): strings that share
their first ``LENGTH`` bytes stand together in the order of its suffixes.

A name with more than ``HOT`` different stretches (a passage in very many documents) is split: its
stretches are cut into single strings, named by all their bytes, before they are gathered.

Documents with equal texts are one text throughout, counted as often as it occurs.

Defined cases: null text is empty; texts shorter than LENGTH lose nothing; null doc_ids and
repeated rows are rows like others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeweave.llm.induced import Disk, sorted_suffixes
from gradeweave.llm.textnum import blocks, mix64, range_hashes, utf8
from gradeweave.sources.shared import shared_dir, stage

LENGTH, GRAM = 200, 32
HOT = 50_000
#: Bytes of different stretches in a shard, about: its names are then sorted in memory (``induced.BASE``).
SHARD = 8 << 20
TEXT_KEY = ["k1", "k2"]


def text_key(text: Column) -> dict[str, Column]:
    """80 bits that stand for a text."""
    return {"k1": F.xxhash64(text), "k2": F.shiftright(F.xxhash64(F.lit("k2"), text), 48).cast("short")}


def distinct_texts(docs: DataFrame, length: int) -> DataFrame:
    """Texts of ``length`` bytes and more, once, with the number of their copies; stored in buckets by key.

    Later joins bring small rows to the texts where they are: no text is shuffled again.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("binary")
    rows = docs.where(F.octet_length("text") >= length).select(text.alias("text")).withColumns(text_key(F.col("text")))
    kept = rows.groupBy(*TEXT_KEY).agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    name = f"texts_{uuid4().hex}"
    path = f"{shared_dir(spark).rstrip('/')}/gradeweave/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept.write.bucketBy(buckets, *TEXT_KEY).option("path", path).option("compression", "zstd").format("parquet").saveAsTable(name)
    return spark.table(name)


def _stretches(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Per stretch of starts with one name: document, first start, number of starts, name, hash of its bytes, may repeat in itself."""
    none = np.zeros(0, np.int64)
    n, window = len(data), length - GRAM + 1
    if n < length:
        return none, none, none, none, none, none.astype(bool)
    at = np.arange(n - GRAM + 1)
    grams = range_hashes(data, at, at + GRAM)
    # the top half of the hash, then the place: the least is the leftmost of the smallest
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    width = 1
    while width * 2 <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        least = np.minimum(least[: len(least) - (window - width)], least[window - width :])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    many = np.maximum(np.diff(offsets) - length + 1, 0)
    owner = np.repeat(np.arange(len(many)), many)
    starts = np.arange(many.sum()) + np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
    if not len(starts):
        return none, none, none, none, none, none.astype(bool)
    place = place[starts]
    name = grams[place]
    new = np.ones(len(starts), bool)
    new[1:] = (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(starts)))
    moves = np.zeros(len(starts), np.int64)
    moves[1:] = (place[1:] != place[:-1]) & ~new[1:]
    itself = np.add.reduceat(moves, head) > 0
    first = starts[head]
    body = range_hashes(data, first, first + size + length - 1)
    return owner[head], first - offsets[owner[head]], size, name[head], body, itself


def stretches(texts: DataFrame, length: int) -> DataFrame:
    """name, body (a hash), k1, k2, copies, first, starts, itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            owner, first, size, name, body, itself = _stretches(data, offsets, length)
            own = pa.array(owner)
            for i in range(0, len(owner), 50_000):
                part = slice(i, i + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[part].astype(np.int64)), pa.array(body[part].astype(np.int64)), *[batch.column(c).take(own[part]) for c in (0, 1, 2)],
                     pa.array(first[part].astype(np.int32)), pa.array(size[part].astype(np.int32)), pa.array(itself[part])],
                    names=["name", "body", "k1", "k2", "copies", "first", "starts", "itself"])

    return texts.select("k1", "k2", "copies", "text").mapInArrow(
        run, "name bigint, body bigint, k1 bigint, k2 smallint, copies bigint, first int, starts int, itself boolean")


def _split_hot(found: DataFrame, texts: DataFrame, length: int, hot: int) -> DataFrame:
    """Stretches of names with more than ``hot`` different ones, cut into single strings under their own names."""
    names = found.groupBy("name", "body").agg(F.lit(1).alias("one")).groupBy("name").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("name")
    names = stage(names, "hot-names")
    if names.isEmpty():
        return found
    crowded = found.join(names, "name", "left_semi").groupBy(*TEXT_KEY).agg(F.collect_list(F.struct("first", "starts")).alias("cut"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            cuts = batch.column(4).to_pylist()
            owner = np.array([d for d, c in enumerate(cuts) for s in c for _ in range(s["starts"])], np.int64)
            first = np.array([s["first"] + i for c in cuts for s in c for i in range(s["starts"])], np.int64)
            at = offsets[owner] + first
            name = range_hashes(data, at, at + length).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(mix64(name.astype(np.uint64)).astype(np.int64)), pa.array(name), *[batch.column(c).take(pa.array(owner)) for c in (0, 1, 2)],
                 pa.array(first.astype(np.int32)), pa.array(np.ones(len(owner), np.int32)), pa.array(np.zeros(len(owner), bool))],
                names=["name", "body", "k1", "k2", "copies", "first", "starts", "itself"])

    single = texts.join(crowded, TEXT_KEY).select("k1", "k2", "copies", "text", "cut").mapInArrow(run, found.schema)
    return found.join(names, "name", "left_anti").unionByName(stage(_repeated(single), "single-strings"))


def _repeated(found: DataFrame) -> DataFrame:
    """Only stretches whose name occurs again: counting the names goes first, so a frequent one meets a single row."""
    names = found.groupBy("name").agg(F.sum("copies").alias("n"), F.max("itself").alias("itself")).where("n > 1 or itself").select("name")
    return found.join(names, "name", "left_semi")


def _sort_shard(length: int):
    """Per partition: name, body and the ranges of starts that hold repeats, by sorting the suffixes of all its stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:
            disk = Disk(folder)
            path = disk.path()
            names, bodies, copies, sizes = [], [], [], []
            with open(path, "wb") as f:
                for batch in batches:
                    data, offsets = utf8(batch.column(3))
                    n = len(batch)
                    if not n:
                        continue
                    # symbols: 0 the end of the shard, 1 the end of a stretch, bytes from 2 on (UTF-8 ends at 0xF4)
                    out = np.ones(len(data) + n, np.uint8)
                    out[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = data + 2
                    out.tofile(f)
                    names.append(np.array(batch.column(0)))
                    bodies.append(np.array(batch.column(1)))
                    copies.append(np.array(batch.column(2)))
                    sizes.append(np.diff(offsets))
                np.zeros(1, np.uint8).tofile(f)
            if not names:
                return
            names, bodies, copies, sizes = (np.concatenate(x) for x in (names, bodies, copies, sizes))
            text = np.memmap(path, np.uint8, "r")
            begin = np.concatenate([[0], np.cumsum(sizes + 1)])
            marks, weights = disk.array(len(text), np.uint8), disk.array(len(text), np.uint8)
            for low in range(0, len(names), 20_000):  # of each start, whether there are one or more of it; 0 for what only goes along
                part = slice(low, low + 20_000)
                own = sizes[part] - length + 1
                step = np.zeros(begin[min(low + 20_000, len(names))] - begin[low] + 1, np.int8)
                once = np.minimum(copies[part], 2).astype(np.int8)
                step[begin[:-1][part] - begin[low]] = once
                step[begin[:-1][part] - begin[low] + own] -= once
                weights[begin[low] : begin[low] + len(step) - 1] = np.cumsum(step[:-1], dtype=np.int8)
            _mark(text, weights, marks, disk, length)
            for low in range(0, len(names), 20_000):
                part = np.arange(low, min(low + 20_000, len(names)))
                local = np.asarray(marks[begin[low] : begin[part[-1] + 1]]).astype(np.int8)
                edge = np.diff(np.concatenate([[0], local, [0]]))
                a, b = np.flatnonzero(edge == 1) + begin[low], np.flatnonzero(edge == -1) + begin[low]
                owner = np.searchsorted(begin, a, "right") - 1
                which, cut = np.unique(owner, return_index=True)
                if len(which):
                    lists = [pa.ListArray.from_arrays(pa.array(np.append(cut, len(owner)), pa.int32()), pa.array((x - begin[owner]).astype(np.int32))) for x in (a, b)]
                    yield pa.RecordBatch.from_arrays([pa.array(names[which]), pa.array(bodies[which]), *lists], names=["name", "body", "low", "high"])
            del text, marks, weights

    return run


def _mark(text: np.ndarray, weights: np.ndarray, marks: np.ndarray, disk: Disk, length: int) -> None:
    """Mark every start whose first ``length`` bytes some other start has, or its own stretch has as often as it has copies."""
    pending, count = -1, 0  # of the group that goes on from the last block: a start not yet marked, and the starts so far
    for at, common in sorted_suffixes(text, disk, length):
        weight = weights[at]
        new = common < length
        if pending < 0 or new[0]:
            pending, count = -1, 0
        group = np.cumsum(new)  # group 0 goes on from the last block
        total = np.bincount(group, weight)
        total[0] += count
        again = (total[group] > 1) & (weight > 0)
        marks[at[again]] = 1
        if pending >= 0 and total[0] > 1:
            marks[pending] = 1
        mine = np.flatnonzero((group == group[-1]) & (weight > 0))
        if group[-1] > 0:
            pending, count = -1, 0
        if len(mine):
            pending, count = int(at[mine[0]]), count + int(weight[mine].sum(dtype=np.int64))


def shards_of(size: int, least: int) -> int:
    """How many shards stretches of ``size`` bytes make: more text is more shards, not larger ones, however few partitions a shuffle has."""
    return max(least, -(-size // SHARD))


def repeated_ranges(texts: DataFrame, length: int, hot: int) -> DataFrame:
    """Per text with repeats: k1, k2 and ranges (low, high) of starts of strings that also start elsewhere."""
    spark = texts.sparkSession
    found = _split_hot(stage(_repeated(stage(stretches(texts, length), "all-stretches")), "stretches"), texts, length, hot)
    kinds = stage(found.groupBy("name", "body").agg(F.sum("copies").alias("copies"), F.min(F.struct("k1", "k2", "first", "starts")).alias("one")), "different-stretches")
    size = kinds.agg(F.sum((F.col("one.starts") + (length - 1)).cast("bigint"))).first()[0] or 0
    wanted = kinds.groupBy("one.k1", "one.k2").agg(F.collect_list(F.struct("name", "body", "copies", "one.first", "one.starts")).alias("cut"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            rows = [(c["name"], c["body"], c["copies"], data[a + c["first"] : a + c["first"] + c["starts"] + length - 1].tobytes())
                    for a, cut in zip(offsets.tolist(), batch.column(1).to_pylist()) for c in cut]
            for i in range(0, len(rows), 5000):
                cols = list(zip(*rows[i : i + 5000]))
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.binary())],
                                                 names=["name", "body", "copies", "text"])

    gathered = texts.join(wanted.hint("shuffle_hash"), TEXT_KEY).select("text", "cut").mapInArrow(extract, "name bigint, body bigint, copies bigint, text binary")
    shards = shards_of(size, int(spark.conf.get("spark.sql.shuffle.partitions")))
    marked = stage(gathered.repartition(shards, "name").mapInArrow(_sort_shard(length), "name bigint, body bigint, low array<int>, high array<int>"), "repeats")
    moved = lambda c: F.transform(c, lambda x: x + F.col("first"))
    return (
        found.select("name", "body", "k1", "k2", "first").join(marked, ["name", "body"])
        .groupBy(*TEXT_KEY).agg(F.flatten(F.collect_list(moved("low"))).alias("low"), F.flatten(F.collect_list(moved("high"))).alias("high"))
    )


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            removed, spans, digests, starts, ends = [], [], [], [], []
            lows, highs = (batch.column(i) for i in (3, 4))
            for d, (a, b) in enumerate(zip(offsets, offsets[1:])):
                step = np.zeros(b - a + 1, np.int32)
                np.add.at(step, np.asarray(lows[d].values), 1)
                np.add.at(step, np.asarray(highs[d].values) + length - 1, -1)
                gone = np.cumsum(step[:-1]) > 0
                edge = np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))
                removed.append(int(gone.sum()))
                starts.append(np.flatnonzero(edge == 1).tolist())
                ends.append(np.flatnonzero(edge == -1).tolist())
                spans.append(len(starts[-1]))
                digests.append(hashlib.sha256(data[a:b][~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string()),
                 *[pa.array(x, pa.list_(pa.int64())) for x in (starts, ends)]],
                names=["k1", "k2", "n_removed", "n_spans", "kept_sha256", "span_starts", "span_ends"])

    return run


def removed_spans(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """Per text that loses bytes: k1, k2 (``text_key``), n_removed, n_spans, kept_sha256, and the byte spans."""
    texts = distinct_texts(docs.select("text"), length)
    ranges = repeated_ranges(texts, length, hot)
    return texts.join(ranges.hint("shuffle_hash"), TEXT_KEY).select("k1", "k2", "text", "low", "high").mapInArrow(
        _cut(length), "k1 bigint, k2 smallint, n_removed bigint, n_spans bigint, kept_sha256 string, span_starts array<bigint>, span_ends array<bigint>")


def suffix_dedup(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    spans = stage(removed_spans(docs, length, hot).drop("span_starts", "span_ends"), "removed")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text, 256).alias("whole"),
                       *[c.alias(k) for k, c in text_key(text).items()])
    return rows.join(spans, TEXT_KEY, "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"))
