"""Arrow vector columns as integer matrices in fixed point.

An entry c, as double, becomes floor(256 * c). Rows whose vector is null, or holds a null or an
entry that is not finite, are no vectors. Numbers beyond a limit that the operator names, far from
any entry of an embedding, are held at it, so that sums stay in 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
#: Entries worked on at a time.
BLOCK_ENTRIES = 1 << 18


def is_vector(column: Column) -> Column:
    """Not null, and all entries are finite numbers."""
    finite = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return column.isNotNull() & F.coalesce(finite, F.lit(False))


def dimension(rows: DataFrame, vector: str) -> int | None:
    """The length that most vectors have, the greater of equally frequent ones; None without vectors."""
    found = rows.where(is_vector(F.col(vector))).groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n"))
    first = found.orderBy(F.desc("n"), F.desc("d")).first()
    return first.d if first else None


def matrices(batches: Iterator[pa.RecordBatch], vector: str, d: int, largest: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Blocks of the batches, without rows that are no vectors of ``d`` entries, and their integer matrix."""
    step = max(1, BLOCK_ENTRIES // max(d, 1))
    for whole in batches:
        for at in range(0, len(whole), step):
            batch = whole.slice(at, step)
            column = batch.column(batch.schema.get_field_index(vector))
            sizes = np.asarray(column.value_lengths().fill_null(-1))
            batch = batch.filter(pa.array(sizes == d))
            column = batch.column(batch.schema.get_field_index(vector))
            entries = column.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(len(batch), d)
            good = np.isfinite(entries).all(axis=1)
            if not good.all():
                batch, entries = batch.filter(pa.array(good)), entries[good]
            if len(batch):
                with np.errstate(over="ignore"):
                    yield batch, np.clip(np.floor(SCALE * entries), -largest, largest).astype(np.int64)


def int_lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of a matrix as lists."""
    n, d = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * d, pa.int32()), pa.array(np.ascontiguousarray(x).ravel(), kind))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """Lists of ``d`` numbers each as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)
