"""Running values over ordered rows, without one task per group.

A file or section may hold a large share of all rows, so nothing here runs one window over
it. Rows come in blocks of bounded size (the splits Spark reads a file in, or ranges of an
integer key). A window runs inside each block; what a block hands on to the next one is a
single row per block, and a window over those rows gives every block its starting value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = ["file", "block"]


def in_block(strict: bool = False):
    """Rows of a block up to the current one, or up to the one before it."""
    return Window.partitionBy(*BLOCK).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1 if strict else 0)


def earlier_blocks():
    return Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def carry_forward(
    df: DataFrame,
    last: dict[str, Column] | None = None,
    counts: dict[str, Column] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Add running values in file order.

    ``last`` adds the latest non-NULL value per name, at the current row or (``strict``)
    before it; ``counts`` adds how many rows met a condition so far, the current one included.
    """
    last, counts = last or {}, counts or {}
    local = df.withColumns({**last, **{n: F.when(c, F.lit(1)).otherwise(F.lit(0)).cast("bigint") for n, c in counts.items()}})
    handed = local.groupBy(*BLOCK).agg(
        *[F.max_by(n, F.when(F.col(n).isNotNull(), F.col("pos"))).alias(n) for n in last],
        *[F.sum(n).alias(n) for n in counts],
    )
    carried = handed.select(
        *BLOCK,
        *[F.last(n, ignorenulls=True).over(earlier_blocks()).alias(f"_{n}") for n in last],
        *[F.coalesce(F.sum(n).over(earlier_blocks()), F.lit(0)).alias(f"_{n}") for n in counts],
    )
    running = local.withColumns({
        **{n: F.last(n, ignorenulls=True).over(in_block(strict)) for n in last},
        **{n: F.sum(n).over(in_block()) for n in counts},
    })
    return (
        running.join(carried, BLOCK)
        .withColumns({
            **{n: F.coalesce(F.col(n), F.col(f"_{n}")) for n in last},
            **{n: F.col(n) + F.col(f"_{n}") for n in counts},
        })
        .drop(*[f"_{n}" for n in [*last, *counts]])
    )


def running_lines(counted: int | None = None) -> Callable[[Iterator], Iterator]:
    """For ``mapInArrow``: values that run along the rows of each split (``file``, ``start``), added to Arrow batches of one task's rows in file order.

    Whether a split starts inside quotes is not known yet, so each value is given for both cases (``_off``, ``_on``):
    ``inside``, the state before the row; ``kind``, the latest ``number`` of a row that starts outside quotes, or -1;
    ``section``, how many such rows had number 0; ``back``, how many rows up the latest row is that starts outside, or -1.
    The last row of a split in each batch has ``mark``. Rows are never held beyond their batch.

    ``times`` says how many rows a row stands for: one, unless ``counted`` names a kind. Then rows that are ``sound``, and in
    both cases start outside quotes, are of that kind and come after a section's start in their split, are given once for
    each section in a batch.
    """

    def run(batches):  # inside, as workers need not have this package
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        split, carried = None, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            file = batch.column("file")
            start, pos, number = (batch.column(c).to_numpy() for c in ("start", "pos", "number"))
            opens, stays = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("opens", "stays"))
            changes = pc.not_equal(file.slice(1), file.slice(0, n - 1)).to_numpy(zero_copy_only=False) | (start[1:] != start[:-1])
            bounds = [0, *(np.flatnonzero(changes) + 1), n]
            mark = np.zeros(n, bool)
            found = {f"{c}_{x}": np.empty(n, t) for c, t in (("inside", bool), ("kind", "i1"), ("section", "i8"), ("back", "i8")) for x in ("off", "on")}
            for lo, hi in zip(bounds, bounds[1:]):
                if split != (here := (file[lo].as_py(), int(start[lo]))):
                    split, carried = here, {"off": (False, -1, 0, -1), "on": (here[1] > 0, -1, 0, -1)}  # no file starts inside
                part = slice(lo, hi)
                mark[hi - 1] = True
                i = np.arange(hi - lo)
                # a row sets or clears the state, flips it, or keeps it
                flips = np.cumsum(opens[part] & ~stays[part])
                fixed = np.maximum.accumulate(np.where(opens[part] == stays[part], i, -1))
                at = np.maximum(fixed, 0)
                odd = np.where(fixed >= 0, flips - flips[at], flips) % 2 == 1
                for x, (state, kind, section, first) in carried.items():
                    after = np.where(fixed >= 0, opens[part][at], state) ^ odd
                    inside = np.concatenate([[state], after[:-1]])
                    heads = ~inside & (number[part] >= 0)
                    head = np.maximum.accumulate(np.where(heads, i, -1))
                    kinds = np.where(head >= 0, number[part][np.maximum(head, 0)], kind)
                    sections = section + np.cumsum(heads & (number[part] == 0))
                    firsts = np.maximum(np.maximum.accumulate(np.where(inside, -1, pos[part])), first)
                    for c, values in (("inside", inside), ("kind", kinds), ("section", sections), ("back", np.where(firsts >= 0, pos[part] - firsts, -1))):
                        found[f"{c}_{x}"][part] = values
                    carried[x] = bool(after[-1]), int(kinds[-1]), int(sections[-1]), int(firsts[-1])
            added = found | {"mark": mark}
            times = np.ones(n, "i8")
            if counted is not None:
                alike = batch.column("sound").to_numpy(zero_copy_only=False) & ~mark
                for x in carried:
                    alike &= ~found[f"inside_{x}"] & (found[f"kind_{x}"] == counted) & (found[f"section_{x}"] > 0)
                at = np.flatnonzero(alike)
                key = np.stack([np.searchsorted(bounds, at, "right"), found["section_off"][at], found["section_on"][at]])
                new = np.flatnonzero(np.concatenate([np.ones(min(len(at), 1), bool), (key[:, 1:] != key[:, :-1]).any(0)]))
                times[at[new]] = np.diff(new, append=len(at))
                kept = ~alike
                kept[at[new]] = True
                batch, added, times = batch.filter(pa.array(kept)), {c: v[kept] for c, v in added.items()}, times[kept]
            added["times"], names = times, [c for c in batch.schema.names if c != "sound"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), *map(pa.array, added.values())], [*names, *added])

    return run


def split_starts(lines: DataFrame) -> DataFrame:
    """What each split starts with, from its last row as ``running_lines`` has it: one row per ``file`` and ``start``.

    ``_inside`` (off at the start of a file), ``_kind``, ``_section`` and ``_first``, the position of the row that begins
    the record in which the split starts; and ``_endless``, the same of a record still open at the end of the file.
    """
    key, each = ["file", "start"], ("off", "on")
    after = [F.when(F.col(f"inside_{x}"), F.col("stays")).otherwise(F.col("opens")).alias(f"_if_{x}") for x in each]
    first = [F.when(F.col(f"back_{x}") >= 0, F.col("pos") - F.col(f"back_{x}")).alias(f"first_{x}") for x in each]
    kind = [F.nullif(f"kind_{x}", F.lit(-1)).alias(f"kind_{x}") for x in each]
    last = F.struct(*after, *kind, *first, *[f"section_{x}" for x in each])
    splits = lines.where("mark").groupBy(*key).agg(F.max_by(last, "pos").alias("_last")).select(*key, "_last.*")
    per_file = Window.partitionBy("file").orderBy("start")
    so_far, earlier = per_file.rowsBetween(Window.unboundedPreceding, 0), per_file.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = per_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = _outcomes(splits, so_far).withColumn("_inside", F.lag("_end_off", 1, False).over(per_file))
    known = known.withColumns({c: F.when(F.col("_inside"), F.col(f"{c}_on")).otherwise(F.col(f"{c}_off")) for c in ("kind", "section", "first")})
    return known.select(
        *key, "_inside",
        F.last("kind", ignorenulls=True).over(earlier).alias("_kind"),
        F.coalesce(F.sum("section").over(earlier), F.lit(0)).alias("_section"),
        F.last("first", ignorenulls=True).over(earlier).alias("_first"),
        F.when(F.last("_end_off").over(all_rows), F.last("first", ignorenulls=True).over(all_rows)).alias("_endless"),
    )


def _outcomes(df: DataFrame, window) -> DataFrame:
    off, on = F.col("_if_off"), F.col("_if_on")
    flips = F.sum(F.when(off & ~on, F.lit(1)).otherwise(F.lit(0))).over(window)
    fixed = F.last(F.when(off == on, F.struct(off.alias("state"), F.col("_flips").alias("flips"))), ignorenulls=True)
    odd = (F.col("_flips") - F.coalesce(F.col("_fixed.flips"), F.lit(0))) % 2 == 1
    return (
        df.withColumn("_flips", flips).withColumn("_fixed", fixed.over(window))
        .withColumns({
            "_end_off": F.coalesce(F.col("_fixed.state"), F.lit(False)) != odd,
            "_end_on": F.coalesce(F.col("_fixed.state"), F.lit(True)) != odd,
        })
        .drop("_flips", "_fixed")
    )


def number_rows(df: DataFrame, keys: Sequence[str], order: str, name: str, width: int = 65536) -> DataFrame:
    """``row_number()`` per ``keys`` by a distinct integer column, for groups of any size.

    Ranges of ``width`` order values hold at most ``width`` rows of a group each; rows are
    numbered inside a range, and ranges start after the counts of the earlier ones.
    """
    ranged = df.withColumn("_range", F.floor(F.col(order) / F.lit(width)))
    keyed = [*keys, "_range"]
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(*keyed).agg(F.count("*").alias("_n")).select(
        *keyed, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    number = F.row_number().over(Window.partitionBy(*keyed).orderBy(order))
    return (
        ranged.withColumn(name, number).join(starts, keyed)
        .withColumn(name, F.col(name).cast("bigint") + F.col("_start"))
        .drop("_range", "_start")
    )
