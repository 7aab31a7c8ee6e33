"""Scoring texts by prediction by partial matching: a byte-context trie with escapes and symbol exclusion.

The trie has contexts of up to ``ORDER`` bytes of the lower-cased text. Escapes are estimated by
method C (as many as different symbols seen), and a symbol that a longer context has already ruled
out is excluded from the shorter ones. Every symbol seen after a context was also seen after its
ending, so what a context excludes below it can be summed when the trie is built, and scoring is
one look-up per byte, plus one per escape. A text ends with a symbol of its own.

What tasks count are strings of ORDER + 1 bytes, a stored table with a row per different string. The
trie itself is never whole in one place. A string that was seen in training is answered by its own
context, at most 255 rows next to each other. The most frequent strings (``HEAD_STRINGS`` at most)
and their logarithms go to the tasks, which read each text once, add up what the head answers, and
pass on the other strings; those are joined by string. Strings never seen in training need the
escapes: each different one is scored once, in parts of the trie by the last two bytes of the
context, which hold all shorter contexts but those of orders 0 and 1 (tables of fixed size). A part
has at most ``MAX_ENTRIES`` strings or those of one pair of bytes, of which there are never more
than 2 ** 24. What is passed on grows with the share of the text outside the head: a corpus in
scripts the training documents do not have sends a row for each of its bytes.

``base_score`` is an add-one unigram model of words. Counts of the most frequent words
(``HEAD_WORDS`` at most) go to the tasks; all others are joined by word.

Defined cases: null text is empty (one token, the end); a null doc_id counts as ''; repeated rows
are scored, and learned from, one by one; without training documents all symbols are equally
likely and V and N are 0; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeweave.llm.textnum import IS_WHITE, LOWER, blocks, range_hashes, runs
from gradeweave.sources.shared import stage

ORDER = 4
START, END, SYMBOLS = 0xFE, 0xFF, 255  # neither byte occurs in UTF-8; START is never a symbol
MAX_ENTRIES = 1 << 15
HEAD_STRINGS = 1 << 20
HEAD_WORDS = 1 << 18
END_TOKEN = np.uint64(0x5DEECE66D1234567)
GRAM, TOKEN = 0, 1
#: Distinct keys a task holds before it passes them on.
HELD_KEYS = 2_000_000


def fold(doc_id: str = "doc_id") -> Column:
    """True for documents that are never learned from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 7 == 2


def strings(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each symbol of each document, its ORDER bytes of context and itself as one number; where documents start."""
    n = len(offsets) - 1
    room = ORDER + 1
    padded = np.full(len(data) + n * room, START, np.uint8)
    padded[np.arange(len(data)) + np.repeat(np.arange(1, n + 1) * room - 1, np.diff(offsets))] = LOWER[data]
    ends = offsets[1:] + np.arange(1, n + 1) * room - 1
    padded[ends] = END
    key = padded.astype(np.uint64)
    total = key[ORDER:].copy()
    for back in range(1, ORDER + 1):
        total |= key[ORDER - back : len(key) - back] << np.uint64(8 * back)
    starts = offsets + np.arange(n + 1)
    at = np.arange(starts[-1]) + np.repeat(np.arange(n) * ORDER, np.diff(starts))
    return total[at], starts


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words, and each document's first word; the end token is not among them."""
    data = LOWER[data]
    starts, ends = runs(~IS_WHITE[data], offsets)
    return range_hashes(data, starts, ends), np.searchsorted(starts, offsets)


class _Counter:
    """Counts of keys, merged now and then; handed out when there are too many."""

    def __init__(self, kind: int):
        self.kind, self.parts, self.size = kind, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(keys):
            self.parts.append(np.unique(keys, return_counts=True))
            self.size += len(self.parts[-1][0])
        if self.size > HELD_KEYS:
            self.merge()
            if self.size > HELD_KEYS // 2:
                yield from self.out()

    def merge(self) -> None:
        if len(self.parts) > 1:
            keys, counts = (np.concatenate(x) for x in zip(*self.parts))
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            self.parts = [(keys[first], np.add.reduceat(counts, first))]
        self.size = sum(len(k) for k, _ in self.parts)

    def out(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        for keys, counts in self.parts:
            for at in range(0, len(keys), 100_000):
                k = keys[at : at + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), self.kind, np.int32)), pa.array(k.astype(np.int64)),
                                                  pa.array(counts[at : at + 100_000].astype(np.int64))], names=["kind", "key", "n"])
        self.parts, self.size = [], 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams, words = _Counter(GRAM), _Counter(TOKEN)
    for _, data, offsets in blocks(batches):
        yield from grams.add(strings(data, offsets)[0])
        found, _ = tokens(data, offsets)
        yield from words.add(np.concatenate([found, np.full(len(offsets) - 1, END_TOKEN)]))
    yield from grams.out()
    yield from words.out()


class Trie:
    """Contexts of orders 2 to ORDER that end in some pairs of bytes, and all of orders 0 and 1."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, low: np.ndarray):
        """keys: sorted strings with their counts; low: (256, 256) counts by last byte and symbol, of all strings."""
        self.keys, self.log_p, self.log_c = {}, {}, {}
        self.contexts, self.escape, self.escape_below, self.log_below = {}, {}, {}, {}
        one, zero = low.astype(float), low.sum(0).astype(float)
        self.log_c[1], self.log_c[0] = _log(one), _log(zero)
        self.log_p[1], self.escape[1] = _method_c(one.sum(1), (one > 0).sum(1), one)
        self.log_p[0], self.escape[0] = _method_c(zero.sum(), (zero > 0).sum(), zero)
        self.rest = -np.log10(max(1, SYMBOLS - (zero > 0).sum()))
        self.escape_below[1], self.log_below[1] = _below(zero.sum() - (one > 0) @ zero, (zero > 0).sum() - (one > 0).sum(1))
        parent = None
        levels = {ORDER: (keys, counts)}
        for j in range(ORDER - 1, 1, -1):
            mask = np.uint64((1 << 8 * (j + 1)) - 1)
            k, c = levels[j + 1]
            order = np.argsort(k & mask, kind="stable")
            k, c = (k & mask)[order], c[order]
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, int)
            levels[j] = (k[first], np.add.reduceat(c, first) if len(k) else c)
        for j in range(2, ORDER + 1):
            k, c = levels[j]
            context = k >> np.uint64(8)
            first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(k) else np.zeros(0, int)
            many = np.diff(np.append(first, len(k)))
            total = np.add.reduceat(c, first).astype(float) if len(k) else np.zeros(0)
            which = np.repeat(np.arange(len(first)), many)
            self.keys[j], self.contexts[j] = k, context[first]
            self.log_c[j] = np.log10(c).astype(np.float32)
            self.log_p[j] = (self.log_c[j] - np.log10(total + many)[which]).astype(np.float32)
            self.escape[j] = np.log10(many / (total + many))
            # the same context one byte shorter: what is left there without the symbols seen here
            shorter = k & np.uint64((1 << 8 * j) - 1)
            if j == 2:
                byte, symbol = (shorter >> np.uint64(8)).astype(int), (shorter & np.uint64(255)).astype(int)
                seen, whole, kinds = one[byte, symbol], one.sum(1), (one > 0).sum(1)
                above = (self.contexts[j] & np.uint64(255)).astype(int)
            else:
                seen = levels[j - 1][1][np.searchsorted(levels[j - 1][0], shorter)]
                whole, kinds = parent
                above = np.searchsorted(self.contexts[j - 1], self.contexts[j] & np.uint64((1 << 8 * (j - 1)) - 1))
            excluded = np.add.reduceat(seen.astype(float), first) if len(k) else np.zeros(0)
            self.escape_below[j], self.log_below[j] = _below(whole[above] - excluded, kinds[above] - many)
            parent = total, many
        self._index = None

    def _find(self, j: int, context: bool, keys: np.ndarray) -> np.ndarray:
        if self._index is None:
            self._index = {(i, c): pd.Index(x[i]) for i in self.keys for c, x in ((False, self.keys), (True, self.contexts))}
        return self._index[j, context].get_indexer(pd.Index(keys))

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 of the probability of each string's last symbol after its context."""
        out = np.zeros(len(keys))
        live, under = np.arange(len(keys)), np.full(len(keys), -1)  # under: context one order up that was escaped from
        above = 0
        for j in range(ORDER, -1, -1):
            part = keys[live]
            if j >= 2:
                at = self._find(j, False, part & np.uint64((1 << 8 * (j + 1)) - 1))
                hit = at >= 0
                plain, counted = self.log_p[j], self.log_c[j]
            else:
                symbol = (part & np.uint64(255)).astype(np.int64)
                byte = ((part >> np.uint64(8)) & np.uint64(255)).astype(np.int64)
                at = byte * 256 + symbol if j else symbol
                plain, counted = self.log_p[j].ravel(), self.log_c[j].ravel()
                hit = counted[at] > -1
            fresh = under[live] < 0
            a = live[hit & fresh]
            out[a] += plain[at[hit & fresh]]
            old = hit & ~fresh
            if old.any():
                out[live[old]] += counted[at[old]] - self.log_below[above][under[live[old]]]
            live, part, fresh = live[~hit], part[~hit], fresh[~hit]
            if not len(live):
                return out
            if j >= 2:
                node = self._find(j, True, (part >> np.uint64(8)) & np.uint64((1 << 8 * j) - 1))
            elif j == 1:
                node = ((part >> np.uint64(8)) & np.uint64(255)).astype(np.int64)
                node = np.where(np.isneginf(self.escape[1][node]), -1, node)
            else:
                node = np.where(np.isneginf(self.escape[0]), -1, np.zeros(len(live), np.int64))
            there = node >= 0
            first = there & fresh
            out[live[first]] += self.escape[j][node[first]] if j else self.escape[0]
            again = there & ~fresh
            if again.any():
                out[live[again]] += self.escape_below[above][under[live[again]]]
            under[live[there]] = node[there]
            above = j
        out[live] += self.rest
        return out


def _log(counts: np.ndarray) -> np.ndarray:
    return np.log10(counts, out=np.full(counts.shape, -9.0), where=counts > 0)


def _method_c(total, kinds, counts):
    whole = np.maximum(total + kinds, 1)
    escape = np.log10(np.where(total > 0, kinds / whole, 0.0), out=np.full(np.shape(total), -np.inf), where=np.asarray(total) > 0)
    return _log(counts) - np.log10(whole)[..., None] if np.ndim(whole) else _log(counts) - np.log10(whole), escape


def _below(total: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Escape and denominator of a shorter context without excluded symbols; with none left the escape is certain."""
    whole = np.maximum(total + kinds, 1)
    return np.log10(np.where(kinds > 0, kinds / whole, 1.0)), np.log10(whole)


def _groups(pairs: list) -> np.ndarray:
    """For each pair of last context bytes, the part that answers for it."""
    part_of, part, size = np.zeros(65536, np.int32), 0, 0
    for pair, n in pairs:
        if size + n > MAX_ENTRIES and size:
            part, size = part + 1, 0
        part_of[pair] = part
        size += n
    return part_of


def _pair() -> Column:
    """The last two bytes of the context of a string."""
    return F.shiftright("key", 8) % 65536


def _heads(table: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """The most frequent rows by n, at most ``limit``, and all others; rows of about one frequency go together."""
    level = F.floor(F.log2(F.col("n")) * 8).cast("int")  # 8 a doubling
    steps = sorted((r.level, r.k) for r in table.groupBy(level.alias("level")).agg(F.count("*").alias("k")).collect())
    many, least = 0, 1 << 30
    while steps and many + steps[-1][1] <= limit:
        least, k = steps.pop()
        many += k
    return table.where(level >= least), table.where(level < least)


class Model:
    """What was gathered from training documents, as stored tables: ``strings`` (key, n, log) and ``words`` (key, n).

    ``log`` is log10 of the probability of a string's last byte after the others, by method C.
    """

    def __init__(self, training: DataFrame):
        counts = training.select("text").mapInArrow(_count, "kind int, key bigint, n bigint").groupBy("kind", "key").agg(F.sum("n").alias("n"))
        stored = stage(counts, "ppm-counts")
        grams, self.words = (stored.where(F.col("kind") == k).select("key", "n") for k in (GRAM, TOKEN))
        context = Window.partitionBy(F.shiftright("key", 8))  # 255 rows at most
        whole = F.sum("n").over(context) + F.count("*").over(context)
        self.strings = stage(grams.select("key", "n", (F.log10("n") - F.log10(whole)).alias("log")), "ppm-strings")
        size = self.words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        self.kinds, self.total = size[0], size[1]

    def low(self) -> np.ndarray:
        """Counts by last byte and symbol, of all strings."""
        found = np.zeros((256, 256), np.int64)
        for r in self.strings.groupBy((F.col("key") % 65536).alias("pair")).agg(F.sum("n").alias("n")).collect():  # 65,536 at most
            found[r.pair >> 8, r.pair & 255] += r.n
        return found

    def escaped(self, unseen: DataFrame) -> DataFrame:
        """key and log of different strings that were never seen in training."""
        spark = unseen.sparkSession
        sizes = self.strings.select("key").unionByName(unseen).groupBy(_pair().alias("pair")).agg(F.count("*").alias("n"))
        part_of = _groups(sorted((r.pair, r.n) for r in sizes.collect()))  # 65,536 at most
        parts = F.broadcast(spark.createDataFrame(pd.DataFrame({"pair": np.arange(65536), "part": part_of})))
        known, asked = (t.withColumn("pair", _pair()).join(parts, "pair").select(*t.columns, F.col("part").alias("part"))
                        for t in (self.strings.drop("log"), unseen))
        low = spark.sparkContext.broadcast(self.low())
        logs = known.groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(_escapes(low), "key bigint, log double")
        done = stage(logs, "ppm-unseen")
        low.destroy()
        return done


def _escapes(low):
    def run(known: pa.Table, asked: pa.Table) -> pa.Table:
        found = np.zeros(0)
        if len(asked):
            keys, counts = known.column("key").to_numpy().astype(np.uint64), known.column("n").to_numpy()
            order = np.argsort(keys)
            found = Trie(keys[order], counts[order], low.value).log10(asked.column("key").to_numpy().astype(np.uint64))
        return pa.table({"key": asked.column("key"), "log": pa.array(found, pa.float64())})

    return run


def _head(table: DataFrame, value: str) -> tuple[np.ndarray, np.ndarray]:
    found = table.select("key", value).toArrow()
    return found.column("key").to_numpy().astype(np.uint64), found.column(value).to_numpy()


FIELDS = "n_tokens bigint, n_known bigint, known_log double, words array<bigint>, score double, strings array<bigint>"


def _score(heads, kept: int):
    """Sums over what the head has, and the words and strings of each text that it has not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (words, counts), (strings_, logs) = heads.value
        word_index, word_logs, string_index = pd.Index(words), np.log10(counts + 1.0), pd.Index(strings_)
        for batch, data, offsets in blocks(batches):
            n = len(batch)
            found, first_word = tokens(data, offsets)
            many = np.diff(first_word) + 1
            found = np.insert(found, first_word[1:], END_TOKEN)
            known, known_log, words_left = _looked_up(found, np.concatenate([[0], np.cumsum(many)]), word_index, word_logs)
            _, score, strings_left = _looked_up(*strings(data, offsets), string_index, logs)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(kept)], pa.array(many.astype(np.int64)), pa.array(known), pa.array(known_log), words_left,
                 pa.array(score), strings_left],
                names=[*batch.schema.names[:kept], "n_tokens", "n_known", "known_log", "words", "score", "strings"])

    return run


def _looked_up(keys: np.ndarray, starts: np.ndarray, index: pd.Index, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """For each row (keys from one start to the next, never none): keys in the index, the sum of their values, the other keys."""
    at = index.get_indexer(pd.Index(keys))
    known = at >= 0
    value = np.zeros(len(keys))
    value[known] = values[at[known]]
    left = np.concatenate([[0], np.cumsum(~known)])[starts]
    rows = starts[:-1]
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0), pa.array([], pa.list_(pa.int64()))
    return (np.add.reduceat(known.astype(np.int64), rows), np.add.reduceat(value, rows),
            pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(keys[~known].astype(np.int64))))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score (log10 probabilities) for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    (words, other_words), (common, _) = _heads(model.words, HEAD_WORDS), _heads(model.strings, HEAD_STRINGS)
    heads = docs.sparkSession.sparkContext.broadcast((_head(words, "n"), _head(common, "log")))
    held = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    rows = stage(held.mapInArrow(_score(heads, 3), f"rid bigint, doc_id {kind}, text string, {FIELDS}").drop("text"), "ppm-rows")
    heads.destroy()
    rare = rows.select("rid", F.explode("words").alias("key")).join(other_words, "key")
    asked = rows.select("rid", F.explode("strings").alias("key"))
    unseen = stage(asked.select("key").distinct().join(model.strings, "key", "left_anti"), "ppm-asked")
    logs = model.strings.select("key", "log").unionByName(model.escaped(unseen))
    sums = (rare.select("rid", F.lit(1).alias("known"), F.log10(F.col("n") + 1).alias("word"), F.lit(0.0).alias("string"))
            .unionByName(asked.join(logs, "key").select("rid", F.lit(0).alias("known"), F.lit(0.0).alias("word"), F.col("log").alias("string")))
            .groupBy("rid").agg(F.sum("known").alias("_known"), F.sum("word").alias("_word"), F.sum("string").alias("_string")))
    whole = np.log10(max(1, model.total + model.kinds + 1))
    return rows.join(sums, "rid", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        (F.col("known_log") + F.coalesce("_word", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(whole))).alias("base_score"),
        (F.col("score") + F.coalesce("_string", F.lit(0.0))).alias("score"))


def language_model_scores(docs: DataFrame) -> DataFrame:
    """Learn from the training folds, score all documents."""
    model = Model(docs.where(~fold()))
    return scored(docs, model).select("doc_id", fold().alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("bigint").alias("train_tokens"),
                                      "base_score", "score")
