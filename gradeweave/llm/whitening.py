"""Whitening of embeddings on their leading principal components, found by spectrum slicing.

Vectors in fixed point are integers, so the covariance of the different vectors is exact: tasks
subtract a whole-numbered mean first, multiply in floating point only as far as all products stay
whole, and add up whole numbers; what is left of the mean is taken out at the end, and each entry
is rounded once. Only sums over dimensions, and pairs of them, meet in the driver, which slices the
spectrum of that one matrix (``spectrum``). Rows are then projected where they are.

Different vectors are found by grouping their packed entries, with partial groups on the map side,
so a vector that is a third of the table is one row per task.

Defined cases: vectors that are null, or hold null or non-finite entries, are dropped, and so are
those of another length than most have (the greater of equally frequent ones); repeated rows, and
rows with a null vec_id, are projected each, and count once in the fit; components whose eigenvalue
is zero to rounding (``LEAST_PART`` of the greatest) do not exist, so equal vectors alone give no
rows; components of equal eigenvalues are any orthonormal basis; a deviation that a long cannot hold
is null there and stands in ``wide_deviation``; fixed-point entries are held at +-2**40; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeweave.llm.spectrum import leading
from gradeweave.llm.vectors import dimension, matrices
from gradeweave.sources.shared import stage

COMPONENTS, LEAST_PART = 4, 1e-11
LARGEST = 1 << 40
#: Rows multiplied at a time: products of halves of 20 and 21 bits, summed over these, stay whole in a double.
ROWS = 1 << 11
_WHOLE = pa.decimal128(38, 0)


def packed(x: np.ndarray) -> list[bytes]:
    """Each row as bytes: two per entry where all of its entries fit, else eight."""
    small = (np.abs(x) < 1 << 15).all(axis=1)
    short = x.astype("<i2")
    return [short[i].tobytes() if s else x[i].astype("<i8").tobytes() for i, s in enumerate(small)]


def unpacked(column: pa.Array, d: int) -> np.ndarray:
    rows = column.to_pylist()
    out = np.empty((len(rows), d), np.int64)
    small = np.fromiter((len(r) == 2 * d for r in rows), bool, len(rows))
    for kind, at in (("<i2", np.flatnonzero(small)), ("<i8", np.flatnonzero(~small))):
        out[at] = np.frombuffer(b"".join(rows[i] for i in at), kind).reshape(len(at), d)
    return out


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            yield unpacked(batch.column(0).slice(at, ROWS), d)


def whole_products(y: np.ndarray) -> np.ndarray:
    """y' y, exactly, as Python integers; at most ROWS rows of entries under 2**41."""
    if float(np.abs(y).max(initial=0)) ** 2 * len(y) < 2**53:
        return (y.T.astype(float) @ y.astype(float)).astype(np.int64).astype(object)
    high, low = y >> 20, y & ((1 << 20) - 1)
    high, low = high.astype(float), low.astype(float)
    square, cross, rest = ((a.T @ b).astype(np.int64).astype(object) for a, b in ((high, high), (high, low), (low, low)))
    return (square << 40) + ((cross + cross.T) << 20) + rest


def _cells(at: np.ndarray, totals: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([Decimal(t) for t in totals], _WHOLE)], names=["cell", "total"])


def _summed(rows: DataFrame, run) -> dict[int, int]:
    """Whole sums by cell; as many as dimensions, or pairs of them."""
    found = rows.mapInArrow(run, "cell int, total decimal(38,0)").groupBy("cell").agg(F.sum("total").cast("decimal(38,0)").alias("total")).toArrow()
    return {c: int(t) for c, t in zip(found.column("cell").to_pylist(), found.column("total").to_pylist())}


def _first_moments(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)
        for x in _blocks(batches, d):
            n += len(x)
            total = total + x.sum(axis=0)
        yield _cells(np.arange(d + 1), [n, *total])

    return run


def _second_moments(d: int, middle: np.ndarray):
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for x in _blocks(batches, d):
            total = total + whole_products(x - middle)
        yield _cells(np.arange(len(upper[0])), list(total[upper]))

    return run


@dataclass(frozen=True)
class Whitening:
    """What the fit list gives: ``middle`` + ``left`` / ``n`` is its mean, components are rows, values their eigenvalues."""

    n: int
    middle: np.ndarray
    left: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened coordinates of rows from which ``middle`` is taken."""
        centred = y - np.array([r / self.n for r in self.left])
        return centred @ (self.components / np.sqrt(self.values)[:, None]).T

    def deviations(self, y: np.ndarray) -> list[int]:
        """Sums over dimensions of (n x - S) squared, exactly."""
        left = np.array(self.left, object)
        far = int(np.abs(y).max(initial=0))
        if len(left) * max(far * far, far * self.n) < 1 << 62:
            squares, cross = (y * y).sum(axis=1).tolist(), (y @ left.astype(np.int64)).tolist()
        else:
            z = y.astype(object)
            squares, cross = (z * z).sum(axis=1).tolist(), (z @ left).tolist()
        rest = int((left * left).sum())
        return [self.n * (self.n * s - 2 * c) + rest for s, c in zip(squares, cross)]


def fit(distinct: DataFrame, d: int, components: int) -> Whitening | None:
    """Exact moments of the packed vectors ``x``, and the leading eigenpairs of their covariance."""
    sums = _summed(distinct, _first_moments(d))
    n = sums.get(0, 0)
    if not n:
        return None
    middle = np.array([sums[i + 1] // n for i in range(d)], np.int64)
    left = [sums[i + 1] % n for i in range(d)]
    products = _summed(distinct, _second_moments(d, middle))
    v = np.zeros((d, d))
    for cell, (i, j) in enumerate(zip(*np.triu_indices(d))):
        v[i, j] = v[j, i] = (n * products[cell] - left[i] * left[j]) / (n * n)  # whole numbers, rounded once
    values, vectors = leading(v, components)
    real = values > LEAST_PART * values.max(initial=0)
    return Whitening(n, middle, left, values[real], vectors[real], float(np.trace(v)))


def identity_error(distinct: DataFrame, d: int, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened fit list minus the identity."""
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for x in _blocks(batches, d):
            w = np.column_stack([np.ones(len(x)), model.project(x - model.middle)])
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], names=["cell", "total"])

    found = distinct.mapInArrow(run, "cell int, total double").groupBy("cell").agg(F.sum("total").alias("total")).toArrow()
    total = np.zeros(((k + 1) ** 2))
    total[found.column("cell").to_numpy()] = found.column("total").to_numpy()
    moments = total.reshape(k + 1, k + 1) / model.n
    return float(np.abs(moments[1:, 1:] - np.outer(moments[0, 1:], moments[0, 1:]) - np.eye(k)).max())


def _projected(d: int, model: Whitening):
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in matrices(batches, "x", d, LARGEST):
            y = x - model.middle
            exact = model.deviations(y)
            row = pa.array(np.repeat(np.arange(len(x)), k))
            fits = pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())
            wide = pa.array([None if e < 1 << 63 or e >= 10**38 else Decimal(e) for e in exact], _WHOLE)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), fits.take(row), wide.take(row), pa.array(model.project(y).ravel())],
                names=["vec_id", "component", "deviation", "wide_deviation", "whitened"])

    return run


def _packed_rows(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in matrices(batches, "x", d, LARGEST):
            yield pa.RecordBatch.from_arrays([pa.array(packed(x), pa.binary())], names=["x"])

    return run


def whitened(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, eigenvalue, wide_deviation: a row per vector and component."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    rows = vectors.select("vec_id", F.col(vector).alias("x"))
    d = dimension(rows, "x")
    model = None
    if d:
        distinct = stage(rows.select("x").mapInArrow(_packed_rows(d), "x binary").distinct(), "different-vectors")
        model = fit(distinct, d, components)
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
                                                        "identity_error double, eigenvalue double, wide_deviation decimal(38,0)")
    error = identity_error(distinct, d, model)
    found = rows.mapInArrow(_projected(d, model), f"vec_id {kind}, component int, deviation bigint, wide_deviation decimal(38,0), whitened double")
    value = F.element_at(F.array(*[F.lit(float(e)) for e in model.values]), F.col("component"))
    return found.select("vec_id", "component", F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened", (value / F.lit(model.trace)).alias("explained"),
                        F.lit(error).alias("identity_error"), value.alias("eigenvalue"), "wide_deviation")
