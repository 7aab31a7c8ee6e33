"""Quality by hierarchical empirical Bayes: a document's own evidence, its path's and its host's record.

Evidence is a linear classifier on hashed features of whole texts (words, beginnings of words, and
the document statistics of ``rules`` in steps), one for quality and one for toxicity, trained in
numpy on a bounded sample of labelled documents (about ``SAMPLE_ROWS``, by hash of doc_id).

Sites come from grouped sums of the documents' chances. How far hosts differ, and paths within
hosts, gives by the method of moments how many documents a prior is worth; a host's rate is drawn
to the global one, a path's to its host's, and the fewer documents it has the more. A
document's own chance is left out of the rates it is judged by. The posterior adds the log odds of
the path's rate over the global one to the evidence.

In ``documents`` the host is ``source`` and the path is ``lang`` within it; ``site`` derives both from
a URL. Defined cases: null host or path is a group like any other; null text is empty (judged by
its site and the empty text's evidence); without labels of both kinds evidence is 0; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeweave.llm.rules import FEATURES, statistics
from gradeweave.llm.textnum import IS_WHITE, LOWER, blocks, mix64, range_hashes, runs
from gradeweave.sources.shared import stage

SAMPLE_ROWS = 8000
BITS, PREFIXES = 18, (4, 6)
EPOCHS, BATCH, RATE, L2, LEAST_DOCS = 20, 16, 0.05, 1e-3, 3
HEADS = ["quality", "toxic"]


def site(url: Column) -> tuple[Column, Column]:
    """Host and first path segment of a URL."""
    return F.lower(F.parse_url(url, F.lit("HOST"))), F.regexp_extract(F.parse_url(url, F.lit("PATH")), "^/([^/]*)", 1)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of each document: ids, and where each document's begin."""
    n = len(offsets) - 1
    folded = LOWER[data]
    starts, ends = runs(~IS_WHITE[folded], offsets)
    owner = np.repeat(np.arange(n), np.diff(np.searchsorted(starts, offsets)))
    whole = range_hashes(folded, starts, ends)
    begins = [mix64(range_hashes(folded, starts, np.minimum(ends, starts + p)) + np.uint64(p)) for p in PREFIXES]
    _, x = statistics(data, offsets)
    steps = np.floor(np.clip(np.column_stack([x[:, :1], x[:, 1:2] / 2, x[:, 2:9] * 20, np.log1p(x[:, 9:10]), x[:, 10:] * 20]), 0, 60)).astype(np.uint64)
    coded = mix64(steps + np.arange(len(FEATURES), dtype=np.uint64) * np.uint64(1000) + np.uint64(1 << 40))
    ids = np.concatenate([whole, *begins, coded.ravel()]) >> np.uint64(64 - BITS)
    owner = np.concatenate([owner, *[owner] * len(PREFIXES), np.repeat(np.arange(n), len(FEATURES))]).astype(np.uint64)
    both = np.unique((owner << np.uint64(BITS)) | ids)
    return (both & np.uint64((1 << BITS) - 1)).astype(np.int64), np.searchsorted(both >> np.uint64(BITS), np.arange(n + 1, dtype=np.uint64))


def _sums(weights: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(weights[ids], dtype=np.float64)])
    return total[starts[1:]] - total[starts[:-1]]


def _chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(ids: list[np.ndarray], y: np.ndarray, seed: int = 1) -> tuple[np.ndarray, float]:
    """Logistic regression on present features, each scaled by how much more often one class has it than the other.

    Features of fewer than LEAST_DOCS documents are left out: they would only learn those by heart.
    """
    if not len(y) or y.min() == y.max():
        return np.zeros(1 << BITS), 0.0
    seen = [np.bincount(np.concatenate([x for x, k in zip(ids, y) if k == kind]), minlength=1 << BITS) for kind in (0, 1)]
    scale = np.log((seen[1] + 1) / (y.sum() + 2)) - np.log((seen[0] + 1) / (len(y) - y.sum() + 2))
    scale[seen[0] + seen[1] < LEAST_DOCS] = 0
    weights, bias = np.zeros(1 << BITS), float(np.log(y.mean() / (1 - y.mean())))
    ids = [x[scale[x] != 0] for x in ids]
    rng = np.random.default_rng(seed)
    order = np.arange(len(y))
    for _ in range(EPOCHS):
        rng.shuffle(order)
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            sizes = np.array([len(ids[i]) for i in rows])
            flat = np.concatenate([ids[i] for i in rows])
            d = _chance(_sums(weights * scale, flat, np.concatenate([[0], np.cumsum(sizes)])) + bias) - y[rows]
            used, inverse = np.unique(flat, return_inverse=True)
            g = scale[used] * np.bincount(inverse, np.repeat(d, sizes), len(used)) / len(rows) + L2 * weights[used]
            weights[used] -= RATE * g
            bias -= RATE * d.mean()
    return weights * scale, bias


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in blocks(batches):
        ids, starts = features(data, offsets)
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(1, 3)], pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))],
                                         names=[*HEADS, "ids"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> list[tuple[np.ndarray, float]]:
    """One classifier for each of HEADS; a document labelled more than once counts as its worst label."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    part = min(1.0, sample / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 30)) < int(part * (1 << 30)))
    worst = known.groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality"), F.max(F.coalesce(F.col("toxic").cast("int"), F.lit(0))).alias("toxic"))
    texts = docs.select("doc_id", "text").join(worst, "doc_id").select("text", *HEADS)
    rows = texts.mapInArrow(_sample, "quality int, toxic int, ids array<int>").toArrow()
    ids = [np.asarray(x.values, np.int64) for x in rows.column("ids")]
    order = sorted(range(len(ids)), key=lambda i: ids[i].tobytes())
    return [fit([ids[i] for i in order], (rows.column(h).to_numpy()[order] > 0).astype(float)) for h in HEADS]


def evidence(docs: DataFrame, models: list[tuple[np.ndarray, float]], host: Column, path: Column) -> DataFrame:
    """doc_id, host, path and the log odds of each head. Weights are two tables of fixed size: broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast([(w.astype(np.float32), b) for w, b in models])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            ids, starts = features(data, offsets)
            odds = [pa.array(_sums(w, ids, starts) + b) for w, b in shared.value]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(3)], *odds], names=["doc_id", "host", "path", *HEADS])

    held = docs.select("doc_id", host.cast("string").alias("host"), path.cast("string").alias("path"), "text")
    kind = held.schema["doc_id"].dataType.simpleString()
    return held.mapInArrow(run, f"doc_id {kind}, host string, path string, quality double, toxic double")


def _worth(n: Column, rate: Column, prior: Column) -> Column:
    """How many documents a prior is worth, by moments: the noise of a rate over the spread of rates beyond it."""
    spread = F.sum(n * (rate - prior) ** 2 - prior * (1 - prior)) / F.sum(n)
    mean = F.sum(n * prior * (1 - prior)) / F.sum(n)
    return F.coalesce(F.least(mean / F.greatest(spread, F.lit(1e-9)), F.lit(1e6)), F.lit(1e6))


def posteriors(found: DataFrame, head: str) -> DataFrame:
    """Rows of ``evidence`` with ``<head>_host``, ``<head>_path`` (rates without the row itself) and ``<head>_posterior`` (log odds)."""
    chance = 1 / (1 + F.exp(-F.greatest(F.least(F.col(head), F.lit(30.0)), F.lit(-30.0))))
    sums = [F.count("*").alias("n"), F.sum(chance).alias("s")]
    paths = stage(found.groupBy(F.coalesce("host", F.lit("")).alias("h"), F.coalesce("path", F.lit("")).alias("p"), F.col("host").isNull().alias("hn"), F.col("path").isNull().alias("pn")).agg(*sums), "site-paths")
    hosts = stage(paths.groupBy("h", "hn").agg(F.sum("n").alias("hn_docs"), F.sum("s").alias("hs")), "site-hosts")
    total = hosts.agg(F.sum("hn_docs"), F.sum("hs")).first()
    rate = min(max((total[1] + 0.5) / (total[0] + 1), 1e-6), 1 - 1e-6) if total[0] else 0.5
    prior = F.lit(float(rate))
    host_worth = hosts.agg(_worth(F.col("hn_docs"), F.col("hs") / F.col("hn_docs"), prior)).first()[0]
    host_rate = (F.col("hs") + F.lit(host_worth) * prior) / (F.col("hn_docs") + F.lit(host_worth))
    path_worth = paths.join(hosts, ["h", "hn"]).agg(_worth(F.col("n"), F.col("s") / F.col("n"), host_rate)).first()[0]
    own = paths.join(hosts, ["h", "hn"]).select("h", "p", "hn", "pn", "n", "s", "hn_docs", "hs")
    rows = found.withColumns({"h": F.coalesce("host", F.lit("")), "p": F.coalesce("path", F.lit("")), "hn": F.col("host").isNull(), "pn": F.col("path").isNull()})
    host_without = (F.col("hs") - chance + F.lit(host_worth) * prior) / (F.col("hn_docs") - 1 + F.lit(host_worth))
    path_without = (F.col("s") - chance + F.lit(path_worth) * F.col(f"{head}_host")) / (F.col("n") - 1 + F.lit(path_worth))
    bounded = lambda c: F.greatest(F.least(c, F.lit(1 - 1e-6)), F.lit(1e-6))
    odds = lambda c: F.log(c / (1 - c))
    return (
        rows.join(own, ["h", "p", "hn", "pn"])
        .withColumn(f"{head}_host", bounded(host_without)).withColumn(f"{head}_path", bounded(path_without))
        .withColumn(f"{head}_posterior", F.col(head) + odds(F.col(f"{head}_path")) - odds(prior))
        .drop("h", "p", "hn", "pn", "n", "s", "hn_docs", "hs")
    )


def site_quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """doc_id, host, path, the site's rates, chances of good quality and of toxicity, kept."""
    found = stage(evidence(docs, train(docs, labels), F.col(host), F.col(path)), "site-evidence")
    for head in HEADS:
        found = posteriors(found, head)
    chance = lambda c: 1 / (1 + F.exp(-c))
    return found.select(
        "doc_id", "host", "path", *[c for h in HEADS for c in (f"{h}_host", f"{h}_path")],
        *[chance(F.col(f"{h}_posterior")).alias(f"{h}_score") for h in HEADS],
        ((F.col("quality_posterior") >= 0) & (F.col("toxic_posterior") < 0)).alias("kept"))
