"""MinHash near-deduplication: consistent weighted sampling over TF-IDF shingles, banded, verified.

A text is a weighted set of shingles of five words (one of all its words if it has fewer): the
times a shingle occurs, times the mean inverse document frequency of its words, which are hashed
into ``WORD_BUCKETS`` buckets so that the table of frequencies has a fixed size. Improved
consistent weighted sampling draws ``BANDS * ROWS`` samples, two texts agreeing in each with
their weighted Jaccard similarity as the chance. Texts that agree in all samples of a band meet.

Where texts meet, no pairs are emitted wholesale: the samples they agree in estimate every
similarity, and each text sends the edge that ties it to the others in a spanning tree of greatest
estimates, plus a runner-up. Single-linkage groups are the pieces of that tree, so groups stay
whole with a few pairs per text. Emitted pairs are verified on their whole texts; verified ones
(weighted Jaccard ``SIMILARITY`` or more) are links, and classes are connected components.

Estimates may put pairs that fail before the right one. A text with a partner it did not send, or
was not compared with, is left open if texts of other classes are left open in one of its buckets.
All pairs of open texts that can be similar enough are found by an exact join on their rarest
shingles (``prefix_pairs``), without estimates, and verified, too.

Equal texts are one text from the start and meet again in the result.

Defined cases: null text equals the empty text; texts without words are alike only if equal;
a null doc_id gets a class like any other row, and is never its name unless all in it are null;
repeated rows share a class; an empty table gives an empty result; other columns are ignored, or
passed on by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeweave.llm.components import components
from gradeweave.llm.textnum import IS_WHITE, LOWER, blocks, mix64, range_hashes, runs, utf8, window_hashes
from gradeweave.sources.shared import stage

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 4
SAMPLES = BANDS * ROWS
WORD_BITS = 16
WORD_BUCKETS = 1 << WORD_BITS
#: Counters that order shingles by how many open texts have them. Shingles that share one only make prefixes less rare.
SHINGLE_BUCKETS = 1 << 20
#: Estimates below this are not verified: 3.5 standard deviations under SIMILARITY.
LEAST_AGREEMENT = int(SAMPLES * (SIMILARITY - 3.5 * (SIMILARITY * (1 - SIMILARITY) / SAMPLES) ** 0.5))
#: Rows compared with each other at a time; what meets in larger numbers goes through in sorted blocks, each tied to the one before.
CHUNK = 1024

_rng = np.random.default_rng(20)
_TABLE_BITS = 16
_u = _rng.random((4, 1 << _TABLE_BITS))
_R = (-np.log(_u[0] * _u[1])).astype(np.float32)  # Gamma(2, 1)
_LOG_C = np.log(-np.log(_u[2] * _u[3])).astype(np.float32)  # log of another
_INV_R = (1 / _R).astype(np.float32)
_MUL = (_rng.integers(0, 1 << 31, (2, SAMPLES), dtype=np.uint32) * np.uint32(2) + np.uint32(1)).astype(np.uint32)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[data]
    starts, ends = runs(~IS_WHITE[data], offsets)
    return range_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def _bucket(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - WORD_BITS)).astype(np.int64)


def shingles(words: np.ndarray, first_word: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each document: document, hash, weight; sorted by document."""
    n_words = np.diff(first_word)
    many = np.maximum(n_words - SHINGLE + 1, 0)
    owner = np.repeat(np.arange(len(n_words)), many)
    at = np.arange(many.sum()) + np.repeat(first_word[:-1] - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
    total = np.concatenate([[0.0], np.cumsum(idf[_bucket(words)], dtype=np.float64)])
    h, w = window_hashes(words, SHINGLE)[at] if len(at) else np.zeros(0, np.uint64), (total[at + SHINGLE] - total[at]) / SHINGLE
    few = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    if len(few):
        a, b = first_word[few], first_word[few + 1]
        short = np.array([window_hashes(words[x:y], y - x)[0] for x, y in zip(a, b)], np.uint64)
        owner, h = np.concatenate([owner, few]), np.concatenate([h, mix64(short + (b - a).astype(np.uint64))])
        w = np.concatenate([w, (total[b] - total[a]) / (b - a)])
    key = mix64(owner.astype(np.uint64) + np.uint64(1)) ^ h
    order = np.lexsort((key, owner))
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    begin = np.flatnonzero(new)
    times = np.diff(np.append(begin, len(key)))
    order = order[begin]
    return owner[order], h[order], np.maximum(w[order] * times, 1e-6)


def samples(owner: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """(n, SAMPLES) hashes of what each consistent weighted sample picks; documents without shingles get zeros."""
    out = np.zeros((n, SAMPLES), np.uint64)
    if not len(owner):
        return out
    begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    docs, sizes = owner[begin], np.diff(np.append(begin, len(owner)))
    log_w = np.log(weight).astype(np.float32)
    a, b = (h >> np.uint64(32)).astype(np.uint32), h.astype(np.uint32)
    one = np.float32(1)
    for k in range(SAMPLES):
        at = (a * _MUL[0, k]) >> np.uint32(32 - _TABLE_BITS)
        beta = ((b * _MUL[1, k]) >> np.uint32(8)).astype(np.float32)
        beta *= np.float32(2**-24)
        t = log_w * _INV_R[at]
        t += beta
        np.floor(t, out=t)
        cost = t + one
        cost -= beta
        cost *= _R[at]
        np.subtract(_LOG_C[at], cost, out=cost)
        least = np.minimum.reduceat(cost, begin)
        hits = np.flatnonzero(cost == np.repeat(least, sizes))
        _, first = np.unique(owner[hits], return_index=True)
        pick = hits[first]
        out[docs, k] = mix64(h[pick] + t[pick].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k))
    return out


def _band_hashes(found: np.ndarray) -> np.ndarray:
    total = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)
    for r in range(ROWS):
        total = mix64(total + found[:, r::ROWS])
    return total.astype(np.int64)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """One row per different text: uid, md5, text, row, copies (how many rows have it). Written once.

    ``row`` has all columns of the row with the least doc_id; of several such rows that differ elsewhere, it is any one.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.md5(text).alias("md5"), F.struct(*columns).alias("row"), F.struct(F.col("doc_id").isNull(), "doc_id").alias("_by"))
    kept = rows.groupBy("md5").agg(F.min_by("row", "_by").alias("row"), F.count("*").alias("copies"))
    uid, whole = F.monotonically_increasing_id().alias("uid"), F.coalesce(F.col("row.text"), F.lit("")).alias("text")
    return stage(kept.select(uid, "md5", whole, "row", "copies"), "distinct-texts")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, docs = np.zeros(WORD_BUCKETS, np.int64), 0
    for _, data, offsets in blocks(batches):
        words, first_word = word_hashes(data, offsets)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first_word))
        counts += np.bincount(np.unique(owner * WORD_BUCKETS + _bucket(words)) % WORD_BUCKETS, minlength=WORD_BUCKETS)
        docs += len(offsets) - 1
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(found, -1)), pa.array(np.append(counts[found], docs))], names=["bucket", "n"])


def word_weights(texts: DataFrame) -> np.ndarray:
    """Inverse document frequency by word bucket: WORD_BUCKETS numbers, counted over all texts."""
    rows = texts.select("text").mapInArrow(_count_words, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = dict(zip(rows.column("bucket").to_pylist(), rows.column("n").to_pylist()))
    total = counts.pop(-1, 0)
    df = np.zeros(WORD_BUCKETS)
    df[list(counts)] = list(counts.values())
    return np.log((1 + total) / (1 + df)) + 1


def signatures(texts: DataFrame, idf: Broadcast) -> DataFrame:
    """uid, bands (hash of each band), marks (a byte of each sample) of texts that have words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            words, first_word = word_hashes(data, offsets)
            has = np.flatnonzero(np.diff(first_word))
            found = samples(*shingles(words, first_word, idf.value), len(batch))[has]
            bands, marks = _band_hashes(found), (found >> np.uint64(56)).astype(np.uint8)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(has) + 1) * BANDS, pa.int32()), pa.array(bands.ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(has)), lists, pa.array([m.tobytes() for m in marks], pa.binary())],
                                             names=["uid", "bands", "marks"])

    return texts.select("uid", "text").mapInArrow(run, "uid bigint, bands array<bigint>, marks binary")


def tree_edges(uids: np.ndarray, marks: np.ndarray, least: int = LEAST_AGREEMENT) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning tree of greatest agreement, and each row's runner-up, where the agreement is enough.

    Rows with further partners of enough agreement come as edges to themselves.
    """
    n = len(uids)
    best, link = np.full(n, -1), np.zeros(n, np.int64)
    second, other = np.full(n, -1), np.zeros(n, np.int64)
    out, partners = np.ones(n, bool), np.zeros(n, np.int64)
    now, pairs = 0, []
    for _ in range(n):
        out[now] = False
        if best[now] >= least:
            pairs.append((now, link[now]))
        same = (marks == marks[now]).sum(1)
        same[now] = -1
        partners[now] = (same >= least).sum()
        up = same > best
        second, other = np.where(up, best, np.where(same > second, same, second)), np.where(up, link, np.where(same > second, now, other))
        link, best = np.where(up, now, link), np.where(up, same, best)
        left = np.flatnonzero(out)
        if not len(left):
            break
        now = left[best[left].argmax()]
    pairs += [(i, other[i]) for i in np.flatnonzero(second >= least)]
    a = np.unique(np.sort(np.array(pairs, np.int64).reshape(-1, 2), axis=1), axis=0)
    more = np.flatnonzero(partners > np.bincount(a.ravel(), minlength=n))
    return uids[np.append(a[:, 0], more)], uids[np.append(a[:, 1], more)]


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by band hash; the last row of a full chunk stays as the first of the next one.

    Rows of a band that is not compared as a whole here (in several chunks, or first or last in its
    task, where ranges are cut) are left open, too.
    """
    held: list[tuple] = []

    def flush(rows: list[tuple], whole: bool) -> Iterator[pa.RecordBatch]:
        uids = np.array([r[1] for r in rows], np.int64)
        u = v = uids[:0]
        if len(rows) > 1:
            u, v = tree_edges(uids, np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, SAMPLES))
        if not whole:
            u, v = np.append(u, uids), np.append(v, uids)
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], names=["u", "v"])

    whole = False
    for batch in batches:
        for row in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            if held and row[0] != held[0][0]:
                yield from flush(held, whole)
                held, whole = [], True
            held.append(row)
            if len(held) == CHUNK:
                whole = False
                yield from flush(held, whole)
                held = [held[0], held[-1]]
    yield from flush(held, False)


def meetings(found: DataFrame) -> DataFrame:
    """band, uid of texts that share a band with others. Written once."""
    rows = found.select("uid", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    return stage(rows.join(shared, "band", "left_semi"), "met")


def candidates(found: DataFrame, met: DataFrame) -> DataFrame:
    """Pairs (u > v) of texts to verify, a few per text; (u, u) if u has partners that are not among them."""
    marked = met.join(found.select("uid", "marks"), "uid").select("band", "uid", "marks")
    # a range may end inside a band: what meets often is spread over tasks, in the order of its marks
    dealt = marked.repartitionByRange("band", "marks").sortWithinPartitions("band", "marks", "uid")
    return dealt.mapInArrow(_edges, "u bigint, v bigint").distinct()


def left_open(met: DataFrame, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """uid, component of texts that meet texts of another class and were not compared with all they meet."""
    more = pairs.where("u = v").select(F.col("u").alias("uid")).join(classes.withColumnRenamed("node", "uid"), "uid", "left")
    rows = met.join(more.select("uid", F.coalesce("component", "uid").alias("component")), "uid")
    mixed = rows.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("band")
    return rows.join(mixed, "band", "left_semi").select("uid", "component").distinct()


def _shingle_bucket(h: np.ndarray) -> np.ndarray:
    return (mix64(h) % np.uint64(SHINGLE_BUCKETS)).astype(np.int64)


def _count_shingles(idf: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SHINGLE_BUCKETS, np.int64)
        for _, data, offsets in blocks(batches):
            counts += np.bincount(_shingle_bucket(shingles(*word_hashes(data, offsets), idf.value)[1]), minlength=SHINGLE_BUCKETS)
        at = np.flatnonzero(counts)
        for i in range(0, len(at), 100_000):
            part = at[i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[part])], names=["bucket", "n"])

    return run


def _prefixes(idf: Broadcast, often: Broadcast, similarity: float):
    """For each text its shingles, rarest first, as long as they and what comes after weigh ``similarity`` of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            owner, h, w = shingles(*word_hashes(data, offsets), idf.value)
            order = np.lexsort((h, often.value[_shingle_bucket(h)], owner))
            owner, h, w = owner[order], h[order], w[order]
            weight = np.bincount(owner, w, len(batch))
            total = np.concatenate([[0.0], np.cumsum(w)])
            rest = total[np.searchsorted(owner, owner, "right")] - total[:-1]
            keep = rest >= similarity * weight[owner] * (1 - 1e-6)
            own = pa.array(owner[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[keep].astype(np.int64)), batch.column(0).take(own), batch.column(1).take(own), pa.array(weight[owner[keep]]), pa.array(rest[keep])],
                names=["shingle", "uid", "component", "weight", "rest"])

    return run


def prefix_pairs(held: DataFrame, idf: Broadcast, similarity: float) -> DataFrame:
    """All pairs (u > v) of open texts (uid, component, text) of different classes that can be of that similarity, by an exact bound.

    What two texts share weighs s / (1 + s) of both together, or more, and is not more than what
    either has from their first common shingle on, in any one order of all shingles. With the rarest
    first, that shingle is among the first ninth of the lighter text's weight, and the first fifth of
    the other's (at 0.8): what a family less alike than that has in common comes later.
    """
    context = held.sparkSession.sparkContext
    counts = held.mapInArrow(_count_shingles(idf), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(SHINGLE_BUCKETS, np.int64)
    often[counts.column("bucket").to_numpy()] = counts.column("n").to_numpy()
    shape = "shingle bigint, uid bigint, component bigint, weight double, rest double"
    shared = context.broadcast(often)
    rows = stage(held.mapInArrow(_prefixes(idf, shared, similarity), shape), "open-shingles")
    shared.destroy()
    share = similarity / (1 + similarity) * (1 - 1e-6)
    one = rows.where(F.col("rest") >= 2 * share * F.col("weight")).alias("one")
    two = rows.alias("two")
    lighter = F.struct("one.weight", "one.uid") < F.struct("two.weight", "two.uid")
    enough = F.least("one.rest", "two.rest") >= share * (F.col("one.weight") + F.col("two.weight"))
    met = one.join(two, (F.col("one.shingle") == F.col("two.shingle")) & (F.col("one.component") != F.col("two.component")) & lighter & enough)
    return met.select(F.greatest("one.uid", "two.uid").alias("u"), F.least("one.uid", "two.uid").alias("v")).distinct()


def similarities(one: pa.Array, two: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of whole texts."""
    sets = []
    for column in (one, two):
        data, offsets = utf8(column)
        sets.append(shingles(*word_hashes(data, offsets), idf))
    owner = np.concatenate([s[0] for s in sets])
    key = mix64(owner.astype(np.uint64) + np.uint64(1)) ^ np.concatenate([s[1] for s in sets])
    weight = np.concatenate([s[2] for s in sets])
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    common = np.zeros(len(one))
    np.add.at(common, owner[order[1:]][same], np.minimum(weight[order[1:]], weight[order[:-1]])[same])
    total = np.bincount(owner, weight, len(one))
    return common / np.maximum(total - common, 1e-12)


def verified(pairs: DataFrame, texts: DataFrame, idf: Broadcast, similarity: float) -> DataFrame:
    """Of the pairs those whose texts are at least that similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, _, _ in blocks(iter([whole]), "one"):
                for at in range(0, len(batch), 64):
                    part = batch.slice(at, 64)
                    keep = pa.array(similarities(part.column(2), part.column(3), idf.value) >= similarity)
                    yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], names=["u", "v"])

    used = pairs.select(F.explode(F.array("u", "v")).alias("uid")).distinct()
    needed = stage(texts.select("uid", "text").join(used.hint("shuffle_hash"), "uid", "left_semi"), "candidate-texts")
    first = pairs.join(needed.select(F.col("uid").alias("u"), F.col("text").alias("one")), "u")
    both = first.join(needed.select(F.col("uid").alias("v"), F.col("text").alias("two")), "v")
    return both.select("u", "v", "one", "two").mapInArrow(run, "u bigint, v bigint")


def text_classes(texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """uid, component of every text."""
    idf = texts.sparkSession.sparkContext.broadcast(word_weights(texts))
    found = stage(signatures(texts, idf), "signatures")
    met = meetings(found)
    pairs = stage(candidates(found, met), "pairs")
    parts = components(verified(pairs.where("u > v"), texts, idf, similarity))
    classes = texts.select("uid").join(parts.withColumnRenamed("node", "uid"), "uid", "left").select("uid", F.coalesce("component", "uid").alias("component"))
    opened = stage(left_open(met, pairs, parts), "open")
    if not opened.isEmpty():
        held = stage(texts.select("uid", "text").join(opened, "uid").select("uid", "component", "text"), "open-texts")
        further = stage(prefix_pairs(held, idf, similarity).join(pairs, ["u", "v"], "left_anti"), "further-pairs")
        # what the first links have joined is one node now
        class_of = opened.withColumnRenamed("component", "to")
        links = verified(further, held, idf, similarity)
        for end in ("u", "v"):
            links = links.join(class_of.withColumnRenamed("uid", end), end).drop(end).withColumnRenamed("to", end)
        joined = components(links.distinct()).select(F.col("node").alias("component"), F.col("component").alias("_whole"))
        classes = classes.join(joined, "component", "left").select("uid", F.coalesce("_whole", "component").alias("component"))
    classes = stage(classes, "text-classes")
    idf.destroy()
    return classes


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the least doc_id of its class) and class_size, for every row.

    Classes get their names from different texts; rows only meet their own text.
    """
    held = docs.select("doc_id", "text")
    texts = distinct_texts(held)
    own = texts.select("uid", "md5", "copies", F.col("row.doc_id").alias("doc_id"))
    members = stage(own.join(text_classes(texts, similarity), "uid"), "class-members")
    names = members.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
    named = stage(members.select("md5", "component").join(stage(names, "class-names"), "component").drop("component"), "named-texts")
    rows = held.select("doc_id", F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("md5"))
    return rows.join(named, "md5").select("doc_id", "class_id", "class_size")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class: that of the least doc_id."""
    texts = distinct_texts(docs)
    classes = text_classes(texts, similarity)
    by = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.col("uid"))
    first = texts.select("uid", by.alias("_by")).join(classes, "uid").groupBy("component").agg(F.min_by("uid", "_by").alias("uid")).select("uid")
    return texts.join(first, "uid", "left_semi").select("row.*")
