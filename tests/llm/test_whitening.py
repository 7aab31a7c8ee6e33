"""Eigenpairs against numpy's, moments and deviations against whole numbers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from gradeweave.llm import spectrum, whitening

SCHEMA = "vec_id long, embedding array<{}>, component int, n int, x array<int>"


def check(spark, rows, kind="float", tolerance=1e-9):
    table = spark.createDataFrame([(*r, 7, 8, [9]) for r in rows], SCHEMA.format(kind)).repartition(3)
    got = whitening.whitened(table).collect()
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in good]
    d = max(set(lengths), key=lambda n: (lengths.count(n), n)) if good else 0
    good = [(i, [math.floor(256 * c) for c in v]) for i, v in good if len(v) == d]
    fit = sorted({tuple(x) for _, x in good})
    n = len(fit)
    if d == 0 or n < 2:
        assert got == []
        return
    s = [sum(c) for c in zip(*fit)]
    centred = [[Fraction(a) - Fraction(b, n) for a, b in zip(x, s)] for x in fit]
    v = np.array([[float(sum(x[i] * x[j] for x in centred) / n) for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(4, int((values > 1e-11 * values[0]).sum()))
    assert len(got) == k * len(good)
    assert all(r.n == n and r.identity_error < 1e-6 for r in got)
    seen = sorted(((str(r.vec_id), r.component, r.deviation if r.deviation is not None else int(r.wide_deviation)) for r in got))
    assert seen == sorted((str(i), c + 1, sum((n * a - b) ** 2 for a, b in zip(x, s))) for i, x in good for c in range(k))
    for c in range(k):
        assert [r.explained for r in got if r.component == c + 1] == pytest.approx([values[c] / np.trace(v)] * len(good), rel=1e-9)
        if all(abs(values[c] - e) > 1e-6 * values[0] for j, e in enumerate(values) if j != c):
            want = {str(i): (np.array(x) - np.array([b / n for b in s])) @ vectors[:, c] / values[c] ** 0.5 for i, x in good}
            mine = {str(r.vec_id): r.whitened for r in got if r.component == c + 1}
            sign = 1 if sum(want[i] * mine[i] for i in want) > 0 else -1
            assert max(abs(want[i] * sign - mine[i]) for i in want) < tolerance


def vectors(n, d, seed, middle=0.0):
    rng = np.random.default_rng(seed)
    return (middle + rng.normal(0, 0.2, (n, d)) @ rng.normal(0, 1, (d, d))).astype(np.float32).tolist()


def test_nulls_repeats_and_odd_lengths(spark):
    v = vectors(60, 6, 1)
    rows = list(enumerate(v)) + [(1000 + i, v[3]) for i in range(80)] + [(None, v[4]), (2000, None), (2001, []), (2002, v[0][:5])]
    rows += [(2003, [None] + v[0][1:]), (2004, [float("nan")] + v[0][1:]), (2005, [float("inf")] + v[0][1:])]
    check(spark, rows)


def test_far_from_zero_and_large_numbers(spark):
    check(spark, list(enumerate(vectors(50, 5, 2, middle=30_000.0))), tolerance=1e-7)
    big = [[float(c) * 1e9 for c in x] for x in vectors(40, 4, 3)]
    check(spark, list(enumerate(big + vectors(10, 4, 4))), kind="double", tolerance=1e-7)


def test_fewer_components_than_asked(spark):
    check(spark, [])
    check(spark, [(1, None), (2, []), (3, [])])
    check(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])
    check(spark, [(i, [i / 8, 1.0, -i / 4]) for i in range(9)])
    check(spark, [(i, [float(i == j) for j in range(5)]) for i in range(5)])


def test_counts_and_pairs_of_many_matrices():
    rng = np.random.default_rng(5)
    for trial in range(150):
        n = int(rng.integers(1, 12))
        x = rng.integers(-3, 4, (int(rng.integers(1, 9)), n)).astype(float)
        a = x.T @ x / (1 + trial % 3)
        e = np.linalg.eigvalsh(a)
        for shift in rng.normal(e.mean(), 2 + e.std(), 4):
            assert spectrum.count_below(a, shift) == (e < shift).sum()
        values, found = spectrum.leading(a, 4)
        assert np.abs(values - e[::-1][:4]).max() < 1e-11 * max(1, e[-1])
        assert np.abs(a @ found.T - found.T * values).max() < 1e-10 * max(1, e[-1])
        assert np.abs(found @ found.T - np.eye(len(found))).max() < 1e-12


def test_neighbours_just_outside_an_interval():
    """Eigenvalues as near each other as those of many vectors without a direction of their own: an iteration may leave its interval."""
    for d, seed in ((4, 11), (6, 19), (8, 12), (12, 34)):
        g = np.random.default_rng(seed).standard_normal((d, d))
        a = np.eye(d) + (g + g.T) / 1000
        values, found = spectrum.leading(a, 4)
        assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:4]).max() < 1e-12
        assert np.abs(a @ found.T - found.T * values).max() < 1e-12
        assert np.abs(found @ found.T - np.eye(4)).max() < 1e-12


def test_products_of_halves_are_whole():
    rng = np.random.default_rng(6)
    y = rng.integers(-(1 << 41), 1 << 41, (50, 3))
    z = y.astype(object)
    assert (whitening.whole_products(y) == z.T @ z).all()
    assert (whitening.whole_products(y % 100) == (z % 100).T @ (z % 100)).all()
