"""Connected components of a link table by alternating stars: each round is two groupings, rounds grow with the logarithm of a component.

Links that come together in one batch of a task are replaced by stars of what they connect before
the first round. Stars are split by nothing but Spark's own means: a node's links are rows, its
smallest neighbour is an aggregate, and the join that hands it out is one that AQE can split.
Each round is one write, which also counts and digests what it has written; two equal ones end it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gradeweave.sources.shared import stage


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of every node but the smallest of its component to that."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    least = np.arange(len(nodes))
    while True:
        low = np.minimum(least[a], least[b])
        before = least.copy()
        for side in (a, b):
            np.minimum.at(least, side, low)
            np.minimum.at(least, before[side], low)
        least = least[least]
        if (least == before).all():
            break
    other = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[other], nodes[least[other]]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        u, v = stars(*[batch.column(i).to_numpy() for i in range(2)])
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _written(links: DataFrame) -> tuple[DataFrame, dict]:
    seen = Observation()
    digest = F.bit_xor(F.xxhash64("u", "v")).alias("digest")
    return stage(links.observe(seen, F.count(F.lit(1)).alias("n"), digest), "links"), seen.get


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for links (u, v) of integers; nodes without links do not appear."""
    given = links.where("u <> v").select(F.col("u").cast("bigint").alias("u"), F.col("v").cast("bigint").alias("v"))
    edges, size = _written(given.mapInArrow(_joined, "u bigint, v bigint").distinct())
    while size.get("n"):
        # large star: a node's greater neighbours, and the node itself, to the smallest of all. Links come from the greater
        # node to the smaller, so the centre of a great star has none of its own, and its rows meet a stored table
        least = stage(edges.groupBy("u").agg(F.min("v").alias("least")), "least")
        to = least.select(F.col("u").alias("v"), "least")
        large = edges.join(to, "v", "left").select("u", F.coalesce("least", "v").alias("v")).unionByName(least.select("u", F.col("least").alias("v")))
        # small star: a node's smaller neighbours to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("least"))
        small = large.join(low, "u").where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        after, now = _written(small.unionByName(low.select("u", F.col("least").alias("v"))).distinct())
        edges, size, before = after, now, size
        if now == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
