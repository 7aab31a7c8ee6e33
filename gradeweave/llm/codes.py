"""Vector code compression: product codes whose codebooks are fitted with Drake and Hamerly's adaptive bounds.

Vectors in fixed point are cut into ``PARTS`` equal parts (filled up with zeros if they do not
divide), each with a codebook of ``ENTRIES`` entries. A round assigns every part to its nearest
entry and moves each entry to the mean of its parts.

With each part are stored the ``b`` entries next to the assigned one, nearest first, an ordered
lower bound of the distance to each, and one outer bound for all other entries. When the entries
have moved, bounds shrink by as much. The distance to the assigned entry is computed anew; the
first bound above it tells how many of the stored entries can be nearer. None: the part keeps its
entry. Some: their exact integer distances decide, and the list is put in order. All, and the outer
bound, too: all entries are measured. Bounds are whole numbers, rounded to the safe side, and a
part is only certain when its bound is greater, so ties are decided by integers. After each round
``b`` falls to the length that sufficed ``ENOUGH`` of the parts that needed their list.

Tasks read, bound and write their rows; only sums per entry, ``PARTS * ENTRIES`` of them, meet in
the driver. Rounds are cut by written tables.

Defined cases: vectors that are null, or hold null or non-finite entries, are dropped, and so are
those of another length than most have (the greater of equally frequent ones); fewer kept rows
than entries make smaller codebooks; a null vec_id comes after all others, and rows of one vec_id
are in the order of their vectors; repeated rows are coded each; empty vectors have code 0 and
error 0; fixed-point entries are held at +-2**26 (with 64 dimensions); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeweave.llm.vectors import dimension, int_lists, is_vector, matrices, matrix
from gradeweave.sources.shared import stage

PARTS, ENTRIES, ROUNDS = 16, 64, 2
FIRST_B, LEAST_B, ENOUGH = ENTRIES // 8, 2, 0.95
#: Bounds count this many units to one step of the fixed point.
UNITS = 16
_FAR = np.int64(1 << 62)
#: Rows of a label that has more than this part of all rows are joined by broadcast: there are at most 1 / HOT_LABEL such labels.
HOT_LABEL = 0.001


@dataclass(frozen=True)
class Shape:
    """Dimension, entries per codebook, and what follows from them."""

    d: int
    k: int

    @property
    def width(self) -> int:
        return -(-self.d // PARTS)

    @property
    def largest(self) -> int:
        """So that a squared distance times ``k`` fits in 62 bits."""
        return 1 << ((62 - max(self.width * self.k - 1, 1).bit_length()) // 2 - 1)

    def cut(self, x: np.ndarray) -> np.ndarray:
        """(rows, parts, width)"""
        return np.pad(x, ((0, 0), (0, self.width * PARTS - self.d))).reshape(len(x), PARTS, self.width)


def _below(squares: np.ndarray) -> np.ndarray:
    """Whole units that the root is not under."""
    return np.clip(np.floor(np.sqrt(squares) * UNITS).astype(np.int64) - 1, 0, (1 << 31) - 1)


def _above(squares: np.ndarray) -> np.ndarray:
    return np.ceil(np.sqrt(squares) * UNITS).astype(np.int64) + 1


def measured(x: np.ndarray, book: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of parts (rows, width): the nearest entry, the ``b`` next ones, and bounds, after measuring all entries."""
    k = len(book)
    keys = ((x[:, None, :] - book[None]) ** 2).sum(2) * k + np.arange(k)
    reach = min(b + 2, k)
    keys = np.sort(np.partition(keys, reach - 1, axis=1)[:, :reach] if reach < k else keys, axis=1)
    squares = keys // k
    bounds = np.full((len(x), b + 1), (1 << 31) - 1)  # beyond the last entry there is none
    bounds[:, : reach - 1] = _below(squares[:, 1:])
    near = np.zeros((len(x), b), np.int64)
    near[:, : min(b, reach - 1)] = (keys % k)[:, 1 : b + 1]
    return keys[:, 0] % k, near, bounds


def bounded(x: np.ndarray, book: np.ndarray, code: np.ndarray, near: np.ndarray, bounds: np.ndarray, moved: np.ndarray):
    """The same for entries that have moved by at most ``moved`` units since the bounds were true, and how deep each part looked.

    Depth 0 is a part that was certain, ``b + 1`` one that measured all entries.
    """
    k, b = len(book), near.shape[1]
    bounds = bounds - np.concatenate([moved[near], np.full((len(x), 1), moved.max(initial=0))], axis=1)
    bounds = np.maximum(np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1], 0)
    own = ((x - book[code]) ** 2).sum(1)
    depth = (_above(own)[:, None] >= bounds).sum(1)  # bounds are in order: the first one above ends the list
    code, near = code.copy(), near.copy()
    some = np.flatnonzero((depth > 0) & (depth <= b))
    if len(some):
        listed, z = near[some], depth[some]
        keys = ((x[some, None, :] - book[listed]) ** 2).sum(2) * k + listed
        place = np.arange(b)
        keys = np.where(place < z[:, None], keys, _FAR + place)
        keys = np.sort(np.concatenate([(own[some] * k + code[some])[:, None], keys], axis=1), axis=1)
        code[some] = keys[:, 0] % k
        rest, inside = keys[:, 1:], place < z[:, None]
        near[some] = np.where(inside, rest % k, listed)
        tight = _below(np.where(inside, rest // k, 0))
        bounds[some, :b] = np.where(inside, tight, bounds[some, :b])
        bounds[some] = np.minimum.accumulate(bounds[some][:, ::-1], axis=1)[:, ::-1]
    full = np.flatnonzero(depth > b)
    if len(full):
        code[full], near[full], bounds[full] = measured(x[full], book, b)
    return code, near, bounds, depth


def moves(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """(parts, entries): how far each entry went, in units."""
    squares = ((new - old) ** 2).sum(2)
    return np.where(squares > 0, _above(squares), 0)


def narrowed(near: np.ndarray, bounds: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ``b`` entries at most; the bound after the last one holds for all that follow."""
    return near[:, :b], bounds[:, : min(b, near.shape[1]) + 1]


def next_b(depths: np.ndarray, b: int) -> int:
    """The length that sufficed most parts that looked into their list; depths[i]: parts that looked i deep."""
    listed = depths[1 : b + 1]
    if not listed.sum():
        return min(b, LEAST_B)
    return max(min(b, LEAST_B), int(np.searchsorted(np.cumsum(listed), ENOUGH * listed.sum()) + 1))


STATE = "x array<int>, code array<smallint>, near array<smallint>, bounds array<int>, depth array<smallint>"


def first_books(rows: DataFrame, shape: Shape) -> np.ndarray:
    """The parts of the least vec_ids: (parts, entries, width)."""
    first = rows.where(is_vector(F.col("x")) & (F.size("x") == shape.d)).orderBy(F.asc_nulls_last("vec_id"), "x").limit(shape.k).select("x").toArrow()
    x = [m for batch in first.to_batches() for _, m in matrices(iter([batch]), "x", shape.d, shape.largest)]
    return shape.cut(np.concatenate(x)).transpose(1, 0, 2)


def _assigned(shape: Shape, books: np.ndarray, b: int):
    """Rows of vectors with codes and bounds, all entries measured."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in matrices(batches, "x", shape.d, shape.largest):
            cut = shape.cut(x)
            found = [measured(cut[:, p], books[p], b) for p in range(PARTS)]
            deep = np.full((len(x), PARTS), b + 1)
            yield _state(batch, x, [*found], deep)

    return run


def _state(batch: pa.RecordBatch, x: np.ndarray, found: list, depth: np.ndarray) -> pa.RecordBatch:
    code, near, bounds = (np.stack([f[i] for f in found], axis=1).reshape(len(x), -1) for i in range(3))
    columns = [batch.column(batch.schema.get_field_index(c)) for c in ("vec_id", "label")]
    lists = [(x, pa.int32()), (code, pa.int16()), (near, pa.int16()), (bounds, pa.int32()), (depth, pa.int16())]
    return pa.RecordBatch.from_arrays([*columns, *[int_lists(m, kind) for m, kind in lists]], names=["vec_id", "label", "x", "code", "near", "bounds", "depth"])


def _loaded(batch: pa.RecordBatch, shape: Shape, held: int) -> tuple[np.ndarray, ...]:
    sizes = {"x": shape.d, "code": PARTS, "near": PARTS * held, "bounds": PARTS * (held + 1)}
    return tuple(matrix(batch.column(batch.schema.get_field_index(c)), n).astype(np.int64) for c, n in sizes.items())


def _steps(batches: Iterator[pa.RecordBatch], size: int = 4096) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), size):
            yield batch.slice(at, size)


def _again(shape: Shape, books: np.ndarray, moved: np.ndarray, held: int, b: int, last: bool):
    """Stored rows assigned to moved entries; the last time their codes and errors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches):
            x, code, near, bounds = _loaded(batch, shape, held)
            cut, near, bounds = shape.cut(x), near.reshape(-1, PARTS, held), bounds.reshape(-1, PARTS, held + 1)
            found = []
            for p in range(PARTS):
                found.append(bounded(cut[:, p], books[p], code[:, p], *narrowed(near[:, p], bounds[:, p], b), moved[p]))
            if last:
                new = np.stack([f[0] for f in found], axis=1)
                error = sum(((cut[:, p] - books[p][new[:, p]]) ** 2).sum(1) for p in range(PARTS))
                columns = [batch.column(batch.schema.get_field_index(c)) for c in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([row.tobytes().hex() for row in new.astype(np.uint8)], pa.string()), pa.array(error, pa.int64())],
                                                 names=["vec_id", "label", "code", "error"])
            else:
                yield _state(batch, x, found, np.stack([f[3] for f in found], axis=1))

    return run


def _sums(shape: Shape, b: int):
    """cell, total: sums of the parts of each entry, their count, and how many parts looked how deep; one row per cell and task."""
    k, w = shape.k, shape.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, depths = np.zeros((PARTS, k, w + 1), np.int64), np.zeros(b + 2, np.int64)
        for batch in _steps(batches):
            x, code, depth = (matrix(batch.column(i), n).astype(np.int64) for i, n in ((0, shape.d), (1, PARTS), (2, PARTS)))
            cut = shape.cut(x)
            depths += np.bincount(depth.ravel(), minlength=b + 2)
            for p in range(PARTS):
                order = np.argsort(code[:, p], kind="stable")
                entries, starts = np.unique(code[order, p], return_index=True)
                sums[p, entries, w] += np.diff(np.append(starts, len(order)))
                sums[p, entries, :w] += np.add.reduceat(cut[order, p], starts, axis=0)
        cells = np.concatenate([sums.ravel(), depths])
        used = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(cells[used])], names=["cell", "total"])

    return run


def moved_books(state: DataFrame, books: np.ndarray, shape: Shape, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Each entry as the mean of its parts, rounded down; unused ones as they are. And the counts of depths."""
    cells = state.select("x", "code", "depth").mapInArrow(_sums(shape, b), "cell int, total bigint")
    found = cells.groupBy("cell").agg(F.sum("total").alias("total")).toArrow()  # at most PARTS * k * (width + 1) + b + 2 rows
    flat = np.zeros(PARTS * shape.k * (shape.width + 1) + b + 2, np.int64)
    flat[found.column("cell").to_numpy()] = found.column("total").to_numpy()
    sums, depths = flat[: -(b + 2)].reshape(PARTS, shape.k, shape.width + 1), flat[-(b + 2) :]
    n = sums[:, :, -1:]
    return np.where(n > 0, sums[:, :, :-1] // np.maximum(n, 1), books), depths


def fitted(rows: DataFrame, shape: Shape, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code, error of all vectors in ``x``, and the codebooks."""
    b = held = min(FIRST_B, shape.k - 1)
    books = first_books(rows, shape)
    names = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    state = stage(rows.mapInArrow(_assigned(shape, books, b), f"{names}, {STATE}"), "vector-codes-0")
    for i in range(1, rounds + 1):
        new, depths = moved_books(state, books, shape, held)
        b = next_b(depths, held) if i > 1 else b
        step = _again(shape, new, moves(books, new), held, b, i == rounds)
        columns = "code string, error bigint" if i == rounds else STATE
        state, books, held = stage(state.mapInArrow(step, f"{names}, {columns}"), f"vector-codes-{i}"), new, b
    return state, books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def label_errors(coded: DataFrame) -> DataFrame:
    """Rows with the sum of errors of their label; rows of one label are never gathered."""
    sums = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("_n")), "label-errors")
    total = sums.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hot = sums.where(F.col("_n") > HOT_LABEL * total).select(F.col("label").alias("_label"), "label_error", F.lit(True).alias("_hot"))
    cold = sums.where(F.col("_n") <= HOT_LABEL * total).select(F.col("label").alias("_label"), F.col("label_error").alias("_cold"))
    marked = coded.join(F.broadcast(hot), F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
    rare = marked.where("_hot is null").drop("label_error").join(cold, F.col("label").eqNullSafe(F.col("_label")))
    columns = ["vec_id", "label", "code", "error"]
    return marked.where("_hot").select(*columns, "label_error").unionByName(rare.select(*columns, F.col("_cold").alias("label_error")))


def vector_codes(vectors: DataFrame, vector: str = "embedding", rounds: int = ROUNDS, entries: int = ENTRIES) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector."""
    rows = vectors.select("vec_id", "label", F.col(vector).alias("x"))
    d = dimension(rows, "x")
    if d is None:
        kind = rows.schema["vec_id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, code string, error bigint, label_error bigint, codebooks_sha256 string")
    good = rows.where(is_vector(F.col("x")) & (F.size("x") == d)).limit(entries).count()
    coded, books = fitted(rows, Shape(d, good), rounds)
    return label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


#: Rounds written out by hand; distances to all entries.
SQL = """
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, embedding FROM embeddings
  WHERE coalesce(list_aggregate([coalesce(isfinite(c), false) FOR c IN embedding], 'bool_and'), embedding IS NOT NULL)),
cells AS (
  SELECT r, c // 4 AS part, c % 4 AS place, floor(256 * CAST(embedding[c + 1] AS DOUBLE))::BIGINT AS x
  FROM kept, range(64) t(c)),
points AS (
  SELECT r, part, max(x) FILTER (place = 0) AS a, max(x) FILTER (place = 1) AS b, max(x) FILTER (place = 2) AS c, max(x) FILTER (place = 3) AS d
  FROM cells GROUP BY r, part),
book0 AS (SELECT part, r - 1 AS entry, a, b, c, d FROM points WHERE r <= 64),
""" + "".join(f"""
near{i} AS (
  SELECT p.r, p.part, p.a, p.b, p.c, p.d, min((p.a-e.a)*(p.a-e.a) + (p.b-e.b)*(p.b-e.b) + (p.c-e.c)*(p.c-e.c) + (p.d-e.d)*(p.d-e.d)) AS square,
    arg_min(e.entry, ((p.a-e.a)*(p.a-e.a) + (p.b-e.b)*(p.b-e.b) + (p.c-e.c)*(p.c-e.c) + (p.d-e.d)*(p.d-e.d)) * 64 + e.entry) AS entry
  FROM points p JOIN book{i} e ON e.part = p.part GROUP BY ALL),
""" + (f"""
book{i + 1} AS (
  SELECT o.part, o.entry, coalesce(m.a, o.a) AS a, coalesce(m.b, o.b) AS b, coalesce(m.c, o.c) AS c, coalesce(m.d, o.d) AS d
  FROM book{i} o LEFT JOIN (
    SELECT part, entry, floor(sum(a) / count(*))::BIGINT AS a, floor(sum(b) / count(*))::BIGINT AS b,
      floor(sum(c) / count(*))::BIGINT AS c, floor(sum(d) / count(*))::BIGINT AS d
    FROM near{i} GROUP BY part, entry) m ON m.part = o.part AND m.entry = o.entry),
""" if i < ROUNDS else "") for i in range(ROUNDS + 1)) + f"""
coded AS (
  SELECT r, string_agg(printf('%02x', entry::INT), '' ORDER BY part) AS code, sum(square)::BIGINT AS error FROM near{ROUNDS} GROUP BY r),
whole AS (SELECT sha256(string_agg(concat_ws(',', a, b, c, d), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), whole
"""
