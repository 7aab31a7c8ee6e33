"""Codes, errors and codebooks against rounds that measure everything; bounds that stay true."""

import hashlib
import math

import numpy as np
import pytest

from gradeweave.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error int, x array<int>"


def plain(rows, entries=64, rounds=2):
    """vec_id, code, error, label_error and the digest, by loops over integers; rows: (vec_id, vector, label)."""
    good = [(i, v, t) for i, v, t in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v, _ in good]
    if not good:
        return [], None
    d = max(set(lengths), key=lambda n: (lengths.count(n), n))
    good = sorted([r for r in good if len(r[1]) == d], key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = -(-d // 16)
    cells = [[math.floor(256 * c) for c in v] + [0] * (16 * w - d) for _, v, _ in good]
    parts = [[tuple(x[p * w : p * w + w]) for p in range(16)] for x in cells]
    books = [[x[p] for x in parts[:entries]] for p in range(16)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x[p], e)), i) for i, e in enumerate(books[p])) for p in range(16)] for x in parts]

    for _ in range(rounds):
        found = assign()
        for p in range(16):
            for i in range(len(books[p])):
                own = [x[p] for x, f in zip(parts, found) if f[p][1] == i]
                if own:
                    books[p][i] = tuple(sum(c) // len(own) for c in zip(*own))
    found = assign()
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    errors = [sum(s for s, _ in f) for f in found]
    by_label = {}
    for (_, _, t), e in zip(good, errors):
        by_label[t] = by_label.get(t, 0) + e
    return [(i, "".join(f"{e:02x}" for _, e in f), s, by_label[t]) for (i, _, t), f, s in zip(good, found, errors)], digest


def check(spark, rows, **options):
    table = spark.createDataFrame([(*r, "c", 1, [2]) for r in rows], SCHEMA).repartition(3)
    got = codes.vector_codes(table, **options).collect()
    want, digest = plain(rows, options.get("entries", 64), options.get("rounds", 2))
    assert sorted((tuple(r)[:4] for r in got), key=str) == sorted(want, key=str)
    assert {r.codebooks_sha256 for r in got} <= {digest}
    assert [c for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")] == codes.vector_codes(table, **options).columns


def vectors(n, d, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 0.3, (5, d))
    return (middles[rng.integers(0, 5, n)] + rng.normal(0, 0.05 * spread, (n, d))).astype(np.float32).tolist()


def test_rows_with_nulls_ties_and_repeats(spark):
    v = vectors(150, 32, 1)
    rows = [(i % 120, x, None if i % 7 == 0 else i % 3) for i, x in enumerate(v)]
    rows += [(5, v[0], 1)] * 90 + [(None, v[1], None), (None, None, 1), (200, None, 2), (201, [], 2), (202, [1.0] * 31, 0)]
    rows += [(203, [None] + v[0][1:], 0), (204, [float("nan")] + v[0][1:], 0), (205, [float("-inf")] + v[0][1:], 0)]
    check(spark, rows)
    check(spark, rows, entries=5, rounds=4)


@pytest.mark.parametrize("d, n", [(16, 40), (20, 70), (3, 30)])
def test_few_rows_and_uneven_parts(spark, d, n):
    check(spark, [(i, x, 0) for i, x in enumerate(vectors(n, d, d))])


def test_no_vectors(spark):
    check(spark, [])
    check(spark, [(1, None, 1), (2, [float("inf")], 1)])
    check(spark, [(1, [], 1), (2, [], None)])


def test_one_label_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(codes, "HOT_LABEL", 0.1)
    check(spark, [(i, x, 0 if i % 3 else i) for i, x in enumerate(vectors(200, 16, 9))])


def test_bounds_stay_true_over_many_moves():
    rng = np.random.default_rng(4)
    x = rng.integers(-40, 40, (3000, 3))
    x[:500] = x[0]
    book = x[rng.integers(0, 3000, 40)]
    code, near, bounds = codes.measured(x, book, 12)
    certain = 0
    for b in (12, 12, 7, 3, 3, 2):
        new = book + rng.integers(-2, 3, book.shape) * (rng.random((40, 1)) < 0.5)
        moved = codes.moves(book[None], new[None])[0]
        code, near, bounds, depth = codes.bounded(x, new, code, *codes.narrowed(near, bounds, b), moved)
        book = new
        squares = ((x[:, None] - book[None]) ** 2).sum(2)
        assert (code == (squares * 40 + np.arange(40)).argmin(1)).all()
        far = np.sqrt(squares) * codes.UNITS
        assert (bounds[:, :-1] <= np.take_along_axis(far, near, 1) + 1e-9).all() and (np.diff(bounds) >= 0).all()
        others = far.copy()
        np.put_along_axis(others, np.column_stack([code, near]), np.inf, 1)
        assert (bounds[:, -1] <= others.min(1) + 1e-9).all()
        certain += (depth == 0).sum()
    assert certain > 3000


def test_lists_shrink_to_what_suffices():
    assert codes.next_b(np.array([50, 90, 6, 4, 0, 9]), 4) == 2
    assert codes.next_b(np.array([50, 1, 1, 96, 2, 9]), 4) == 3
    assert codes.next_b(np.array([50, 0, 0, 0]), 2) == 2
