"""Constraint checks as data: one row per rule with the number of rows that break it."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeweave.sources.schemas import KEYS, REFERENCES, REQUIRED, WIDTHS
from gradeweave.sources.shared import stage


def quality_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All rules on the given tables: (table, rule, violations), zero included.

    Each table is read and shuffled once, grouped by all of its key sets at the same time (Spark's
    grouping sets): rows per key, and in the set of no columns the rows that break row rules. Of a
    key that nothing refers to only the repeated values are stored. ``duplicate`` counts the rows
    beyond the first per key, ``orphan`` rows whose key the other table lacks: both from those
    counts, so a crowded key is one row by the time it meets anything.
    """
    counted = {name: stage(_counted(name, df, tables), f"quality-{name}") for name, df in tables.items()}
    checks = [_own_checks(name, df) for name, df in counted.items()]
    checks += [_orphans(name, counted[name], key, target, counted[target]) for name, key, target in REFERENCES if name in tables and target in tables]
    return reduce(DataFrame.unionByName, checks)


def _rules(name: str) -> dict[str, Column]:
    breaks = {f"missing {c}": F.col(c).isNull() for c in REQUIRED[name]}
    return breaks | {f"too_wide {c}": F.length(c) > width for c, width in WIDTHS[name].items()}


def _referred(name: str, tables: Mapping[str, DataFrame]) -> list[list[str]]:
    """Key sets that references of this table, or to it, need every value of."""
    return [key for table, key, target in REFERENCES if name in (table, target) and table in tables and target in tables]


def _label(key: list[str]) -> str:
    return ", ".join(key)


def _counted(name: str, df: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """keys (which key set, blank for the whole table), its columns, n, and counts of broken row rules."""
    referred = _referred(name, tables)
    sets = {_label(key): key for key in [*KEYS.get(name, []), *referred]}
    columns = list(dict.fromkeys(c for key in sets.values() for c in key))
    rules = [F.when(broken, F.lit(1)).otherwise(F.lit(0)).alias(f"rule_{i}") for i, broken in enumerate(_rules(name).values())]
    # bit by bit from the left, grouping_id() tells which columns a set leaves out
    bits = {label: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in key) for label, key in sets.items()}
    which = F.lit("")
    for label, bit in bits.items():
        which = F.when(F.col("_id") == bit, F.lit(label)).otherwise(which)
    grouped = df.select(*columns, *rules).groupingSets([[F.col(c) for c in key] for key in [*sets.values(), []]], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("_id"), F.count("*").alias("n"), *[F.sum(f"rule_{i}").alias(f"rule_{i}") for i in range(len(rules))])
    needed = F.col("keys").isin("", *map(_label, referred)) | (F.col("n") > 1)
    return grouped.withColumn("keys", which).drop("_id").where(needed)


def _own_checks(name: str, counted: DataFrame) -> DataFrame:
    """Row rules and duplicates, from one pass over the counts."""
    sums = {rule: F.when(F.col("keys") == "", F.col(f"rule_{i}")) for i, rule in enumerate(_rules(name))}
    sums |= {f"duplicate {_label(key)}": F.when(_known(key), F.col("n") - 1) for key in KEYS.get(name, [])}
    totals = counted.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(f"total_{i}") for i, x in enumerate(sums.values())])
    rows = F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"total_{i}").alias("violations")) for i, r in enumerate(sums)]))
    return totals.select(F.lit(name).alias("table"), rows)


def _known(key: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key], F.col("keys") == _label(key))


def _orphans(name: str, counted: DataFrame, key: list[str], target: str, other: DataFrame) -> DataFrame:
    astray = counted.where(_known(key)).select(*key, "n").join(other.where(_known(key)).select(*key), key, "left_anti")
    return astray.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
        F.lit(name).alias("table"), F.lit(f"orphan {_label(key)} in {target}").alias("rule"), "violations")
