"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its hashed byte n-grams (2 to 4 bytes of the lower-cased
text, everything but letters being one space), then a linear softmax. Trained in numpy by
stochastic gradient descent. As the mean comes before the linear layer, a bucket is worth its
embedding times the output weights: one number per language, or the embedding itself where there are
more languages than dimensions. A whole text is scored by summing over its n-grams.

Training reads a bounded sample, the whole texts of at most ``SAMPLE_DOCS`` labelled documents of the
training folds, chosen by hash, in pieces of ``PIECE_BYTES`` bytes. One task fits the model, and the
driver only hands it on. Predictions read whole texts.

Rejection: on labelled documents kept out of the gradient steps, the temperature is fitted and the
threshold is set so that at most ``ALPHA`` of rightly labelled texts fall below it, and never above 0.5.

Defined cases: null or letterless text is ``und`` with score 0 and rejected; null lang is never
learned from; null doc_id counts as the text ''; without labelled documents all is ``und``;
other columns are ignored, or passed on by ``keep_identified``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeweave.llm.textnum import blocks, byte_set

BUCKET_BITS, DIM, GRAMS = 16, 16, (2, 3, 4)
SAMPLE_DOCS, PIECE_BYTES = 800, 240
EPOCHS, BATCH, RATE, ALPHA = 4, 64, 4.0, 0.001

# Letters are a to z and everything outside ASCII; UTF-8 bytes of punctuation there do no harm.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def fold(doc_id: str = "doc_id") -> Column:
    """True for documents that are never learned from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes with one space around each document, and the start of each in them."""
    n = len(offsets) - 1
    out = np.full(len(data) + n + 1, 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = _FOLD[data]
    return out, offsets + np.arange(n + 1)


def grams(text: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Per n: the bucket of the n-gram at each place."""
    if len(text) < GRAMS[0]:
        return
    wide = text.astype(np.uint32)
    key = wide
    for n in range(2, GRAMS[-1] + 1):
        if len(text) < n:
            return
        key = (key[:-1] << np.uint32(8)) | wide[n - 1 :]
        if n in GRAMS:
            yield n, ((key * np.uint32(2654435761) + np.uint32(n * 40503)) * np.uint32(2246822519)) >> np.uint32(32 - BUCKET_BITS)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # (dimension, bucket): one per language, or as many as ``out`` has
    bias: np.ndarray
    out: np.ndarray | None = None  # dimension, language
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        text, starts = spaced(data, offsets)
        n_docs = len(offsets) - 1
        total, count = np.zeros((n_docs, len(self.weights))), np.zeros(n_docs)
        for n, ids in grams(text):
            first = np.minimum(starts[:-1], len(ids))
            last = np.maximum(np.minimum(starts[1:] + 1 - (n - 1), len(ids)), first)
            count += last - first
            for k, weight in enumerate(self.weights):
                sums = np.concatenate([[0.0], np.cumsum(weight[ids], dtype=np.float64)])
                total[:, k] += sums[last] - sums[first]
        mean = total / np.maximum(count, 1)[:, None]
        return _softmax(((mean if self.out is None else mean @ self.out) + self.bias) / self.temperature)

    def best(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each document's likeliest language and its probability; tables of documents and languages stay small."""
        step = max(1, (1 << 22) // max(1, len(self.langs)))
        found = []
        for at in range(0, max(1, len(offsets) - 1), step):
            cut = offsets[at : at + step + 1]
            p = self.probabilities(data[cut[0] : cut[-1]], cut - cut[0])
            kind = p.argmax(1)
            found.append((kind, p[np.arange(len(p)), kind]))
        return tuple(np.concatenate(x) for x in zip(*found))


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def _bag(piece: bytes) -> np.ndarray:
    text, _ = spaced(np.frombuffer(piece, np.uint8), np.array([0, len(piece)]))
    return np.concatenate([np.zeros(0, np.uint16), *[ids.astype(np.uint16) for _, ids in grams(text)]])  # BUCKET_BITS are 16


def fit(pieces: list[bytes], labels: list[str], seed: int = 1) -> Model:
    """Train on pieces of text; every tenth is left for the temperature and the threshold."""
    langs = sorted(set(labels))
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (1 << BUCKET_BITS, DIM)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (DIM, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32)
    y = np.searchsorted(langs, labels)
    bags = [_bag(p) for p in pieces]
    held = np.arange(len(bags)) % 10 == 9
    use = np.array([i for i in np.flatnonzero(~held) if len(bags[i])], int)
    steps, done = max(1, EPOCHS * -(-len(use) // BATCH)), 0
    for _ in range(EPOCHS if len(langs) > 1 else 0):
        rng.shuffle(use)
        for at in range(0, len(use), BATCH):
            chosen = use[at : at + BATCH]
            sizes = np.array([len(bags[i]) for i in chosen])
            ids = np.concatenate([bags[i] for i in chosen])
            h = np.add.reduceat(embed[ids], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0) / sizes[:, None]
            d = _softmax(h @ out + bias)
            d[np.arange(len(chosen)), y[chosen]] -= 1
            rate = RATE * (1 - done / steps) / len(chosen)
            pull = (d @ out.T / sizes[:, None]).astype(np.float32)
            out -= (rate * (h.T @ d)).astype(np.float32)
            bias -= (rate * 0.1 * d.sum(0)).astype(np.float32)
            order = np.argsort(ids, kind="stable")
            used, first = np.unique(ids[order], return_index=True)
            embed[used] -= np.float32(rate * 20) * np.add.reduceat(np.repeat(pull, sizes, 0)[order], first, axis=0)
            done += 1
    model = Model(langs, np.ascontiguousarray((embed @ out).T), bias) if len(langs) <= DIM else Model(langs, np.ascontiguousarray(embed.T), bias, out)
    check = np.flatnonzero(held)
    if len(check) and len(langs) > 1:
        body = [pieces[i] for i in check]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in body])]).astype(np.int64)
        z = np.log(np.maximum(model.probabilities(np.frombuffer(b"".join(body), np.uint8), offsets), 1e-300))
        right = np.arange(len(check)), y[check]
        fits = {t: -np.log(np.maximum(_softmax(z / t)[right], 1e-300)).mean() for t in np.geomspace(0.2, 5, 33)}
        model.temperature = float(min(fits, key=fits.get))
        sure = _softmax(z / model.temperature)
        sure = np.sort(sure[right][sure.argmax(1) == y[check]])
        model.threshold = min(0.5, float(sure[int(ALPHA * len(sure))])) if len(sure) else 0.0
    return model


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole texts as pieces, with their language."""
    for batch, data, offsets in blocks(batches):
        rows = [(data[at : min(at + PIECE_BYTES, b)].tobytes(), lang)
                for lang, a, b in zip(batch.column(1).to_pylist(), offsets, offsets[1:]) for at in range(a, b, PIECE_BYTES)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["piece", "lang"])


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row with the model of all pieces of the sample, which are in no order."""
    rows = sorted(row for batch in _pieces(batches) for row in zip(*[c.to_pylist() for c in batch.columns]))
    np.random.default_rng(3).shuffle(rows)
    model = fit([p for p, _ in rows], [lang for _, lang in rows]) if rows else Model([], np.zeros((0, 1), np.float32), np.zeros(0))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])


def train(docs: DataFrame, sample: int = SAMPLE_DOCS) -> Model:
    """Fit on about ``sample`` labelled texts, chosen by a hash of doc_id and text; no more rows meet in the task that fits.

    The share of hashes that gives a few more rows is taken first, each document once, so tasks send
    on a sample of their rows and not as many as the whole sample has.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~fold())
    part = min(1.0, 1.2 * sample / max(1, labelled.count()))
    hashed = labelled.select("text", F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id", "text").alias("_hash"))
    some = hashed.where(F.pmod("_hash", F.lit(1 << 30)) < int(part * (1 << 30)))
    chosen = some.groupBy("_hash").agg(F.min("lang").alias("lang"), F.first("text").alias("text")).orderBy("_hash").limit(sample)
    found = chosen.select("text", "lang").coalesce(1).mapInArrow(_fitted, "model binary").first()
    return pickle.loads(found.model) if found else Model([], np.zeros((0, 1), np.float32), np.zeros(0))


def identify(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns, named _0, _1, ..., with lang_pred, score and rejected.

    The model is at most DIM numbers per bucket, and per language of the sample: broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch, data, offsets in blocks(batches, "_text"):
            letters = batch.column(batch.schema.get_field_index("_letters")).to_numpy(zero_copy_only=False).astype(bool)
            if m.langs:
                best, chance = m.best(data, offsets)
                score = np.where(letters, chance, 0.0)
                pred = [m.langs[k] if ok else "und" for k, ok in zip(best, letters)]
                rejected = ~letters | (score < m.threshold)
            else:
                score, pred, rejected = np.zeros(len(batch)), ["und"] * len(batch), np.ones(len(batch), bool)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(keep))], pa.array(pred, pa.string()), pa.array(score), pa.array(rejected)],
                names=[*batch.schema.names[: len(keep)], "lang_pred", "score", "rejected"])

    held = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)], F.col("text").alias("_text"),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters"))
    fields = ", ".join(f"_{i} {held.schema[i].dataType.simpleString()}" for i in range(len(keep)))
    return held.mapInArrow(run, f"{fields}{', ' if keep else ''}lang_pred string, score double, rejected boolean")


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected."""
    found = identify(docs.select("doc_id", "text"), train(docs), ["doc_id"]).withColumnRenamed("_0", "doc_id")
    return found.select("doc_id", fold().alias("held_out"), "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected."""
    found = identify(docs, train(docs), docs.columns)
    return found.where(~F.col("rejected")).drop("lang_pred", "score", "rejected").toDF(*docs.columns)
