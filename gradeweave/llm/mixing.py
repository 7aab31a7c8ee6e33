"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed 60-bit hash. A source takes all documents below a threshold, so a
mix is a filter: nothing is sorted, and a larger budget takes what a smaller one takes and
more. The threshold comes from histograms: words by source and the first 12 bits of the hash;
the bucket in which a source's budget ends is the only one that is looked into, 12 bits at a time.

Defined cases: null source is a source of its own, after all others; null text has no words;
rows that share one hash (the same doc_id and text) and straddle a budget are taken one by one,
as many as come nearest to it; an empty table
gives an empty mix; other columns are ignored or, in ``mixed_rows``, passed on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeweave.sources.shared import stage

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS, STEP_BITS = 60, 12
#: Up to so many row numbers are broadcast.
SMALL = 100_000


def _measures() -> dict[str, Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text))
    return {
        "_size": F.regexp_count(text, F.lit(WORD)).cast("bigint"),
        "_hash": F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("bigint"),
        "_rid": F.monotonically_increasing_id(),
        "_key": F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source"))),
    }


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Targets of sources (_key, source_size): ``share`` of all words by weight, none above ``most`` times its source.

    Sources reach their ceiling in order of ceiling over weight. One is at its ceiling if the
    level it would get, with all earlier ones at theirs, is not below that. One row per source
    is all that these windows see.
    """
    by_key = Window.orderBy("_key")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_key) - 1) % len(weights) + 1).cast("int"))
    every = Window.partitionBy()
    earlier = Window.orderBy("_ratio", "_key").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    ranked = (
        sizes.withColumn("_weight", weight)
        .withColumn("_top", F.col("source_size") * F.lit(float(most)))
        .withColumn("_ratio", F.col("_top") / F.col("_weight"))
        .withColumn("_all", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("_level", (F.col("_all") - before("_top")) / (F.sum("_weight").over(every) - before("_weight")))
        .withColumn("_full", F.col("_level") >= F.col("_ratio"))
    )
    level = F.first(F.when(~F.col("_full"), F.col("_level")), ignorenulls=True).over(
        Window.orderBy("_ratio", "_key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(F.col("_full"), F.col("_top")).otherwise(F.col("_weight") * level)
    size = F.col("source_size")
    return ranked.select("_key", "source_size", target.alias("target")).withColumn(
        "budget", F.floor(F.col("target") + F.lit(1e-6)).cast("bigint")).withColumns({
        "_copies": F.when(size > 0, F.expr("budget div source_size")).otherwise(F.lit(0)),
        "_left": F.when(size > 0, F.col("budget") % size).otherwise(F.lit(0)),
    }).drop("budget")


def _bucket(level: int) -> Column:
    return F.shiftright("_hash", HASH_BITS - STEP_BITS * level)


def _boundary(rows: DataFrame, budgets: DataFrame, level: int) -> DataFrame:
    """Per source the bucket of this level in which the budget ends, and what is left on entering it."""
    sums = rows.groupBy("_key", _bucket(level).alias("_at")).agg(F.sum("_size").alias("_words"))
    so_far = Window.partitionBy("_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        sums.withColumn("_upto", F.sum("_words").over(so_far))
        .join(budgets.select("_key", "_left"), "_key")
        .where((F.col("_upto") > F.col("_left")) & (F.col("_upto") - F.col("_words") <= F.col("_left")))
        .select("_key", "_at", (F.col("_left") - F.col("_upto") + F.col("_words")).alias("_left"))
    )


def thresholds(measured: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Per source: size, target, whole copies, the hash where its last part ends, and the words left there."""
    sizes = measured.groupBy("_key").agg(F.sum("_size").cast("bigint").alias("source_size"))
    sources = stage(source_targets(sizes, weights, share, most), "mix-sources")
    edge = stage(_boundary(measured, sources, 1), "mix-edge")
    cell = measured.join(edge.select("_key", "_at"), "_key").where(_bucket(1) == F.col("_at")).drop("_at")
    cell = stage(cell, "mix-cell")
    for level in range(2, HASH_BITS // STEP_BITS + 1):
        if level > 2:
            cell = cell.join(edge.select("_key", "_at"), "_key").where(_bucket(level - 1) == F.col("_at")).drop("_at")
        edge = _boundary(cell, edge, level)
        if level < HASH_BITS // STEP_BITS:
            edge = stage(edge, "mix-edge")
    edge = edge.select("_key", "_at", F.col("_left").alias("_rest"))
    return stage(sources.join(edge, "_key", "left"), "mix-thresholds")


def _chosen_ties(measured: DataFrame, found: DataFrame) -> DataFrame:
    """_rid of rows taken once more of those that have the hash at which their source's budget ends.

    They are numbered, in blocks and over blocks, as one document may be there any number of
    times; all of them have one size.
    """
    tied = measured.join(found, "_key").where((F.col("_hash") == F.col("_at")) & (F.col("_size") > 0))
    tied = tied.select("_key", "_rid", "_rest", "_size", F.shiftright("_rid", 16).alias("_block"))
    blocks = tied.groupBy("_key", "_block").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("_key", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_key", "_block").orderBy("_rid"))
    wanted = F.floor(F.col("_rest") / F.col("_size") + 0.5)
    numbered = tied.withColumn("_number", inside).join(starts, ["_key", "_block"])
    chosen = stage(numbered.where(F.col("_number") + F.col("_start") <= wanted).select("_rid", F.lit(True).alias("_tie")), "mix-ties")
    return F.broadcast(chosen) if chosen.count() <= SMALL else chosen


def _with_times(rows: DataFrame, found: DataFrame, ties: DataFrame) -> DataFrame:
    """Rows with what ``found`` has of their source, and ``_times``: how often each is taken."""
    extra = (F.col("_hash") < F.col("_at")) | F.coalesce("_tie", F.lit(False))
    more = F.when((F.col("_size") > 0) & extra, F.lit(1)).otherwise(F.lit(0))
    return rows.join(found, "_key").join(ties, "_rid", "left").withColumn("_times", F.col("_copies") + more)


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken."""
    measured = stage(docs.select("doc_id", "source", "text").withColumns(_measures()).drop("text"), "mix-sizes")
    found = thresholds(measured, weights, share, most)
    return _with_times(measured, found, _chosen_ties(measured, found)).select(
        "doc_id", "source", F.col("_size").alias("size"), "source_size", "target", (F.col("_times") * F.col("_size")).cast("bigint").alias("taken"))


def mixed_rows(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mixed corpus: every row as often as the mix takes it; all columns of ``docs``. Rows without words stay once.

    Only the thresholds, a row per source, are brought to the texts. Rows are told by what is in them,
    so ``docs`` may give its rows in any order each time; the rows with the hash at which a budget ends
    (copies of one document, as a rule) are stored before they are numbered.
    """
    columns = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), "doc_id", "source", "text").withColumns(_measures())
    held = held.select("_row", "_key", "_size", "_hash", "_rid")
    found = thresholds(stage(held.drop("_row"), "mix-sizes"), weights, share, most)
    priced = held.join(found, "_key")
    at_end = F.coalesce((F.col("_hash") == F.col("_at")) & (F.col("_size") > 0), F.lit(False))
    tied = stage(priced.where(at_end).select(held.columns), "mix-tied-rows")
    ties = _with_times(tied, found, _chosen_ties(tied.drop("_row"), found))
    more = F.when((F.col("_size") > 0) & (F.col("_hash") < F.col("_at")), F.lit(1)).otherwise(F.lit(0))
    rest = priced.where(~at_end).withColumn("_times", F.col("_copies") + more)
    times = F.when(F.col("_size") > 0, F.col("_times")).otherwise(F.lit(1)).cast("int")
    both = rest.select("_row", times.alias("_times")).unionByName(ties.select("_row", times.alias("_times")))
    return both.where("_times > 0").select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_times"))).alias("_copy")).select("_row.*")


SQL = r"""
WITH m AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h,
         row_number() OVER (PARTITION BY source, doc_id, md5(coalesce(text, ''))) AS copy
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         list_value(5, 2, 1)[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM m GROUP BY source),
r AS (
  SELECT *, source_size * 2.0::DOUBLE AS top, source_size * 2.0::DOUBLE / w AS ratio,
         sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS budget, sum(w) OVER () AS ws FROM s),
l AS (
  SELECT *, (budget - coalesce(sum(top) OVER before, 0)) / (ws - coalesce(sum(w) OVER before, 0))::DOUBLE AS level
  FROM r WINDOW before AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size,
         CASE WHEN level >= ratio THEN top
              ELSE w * (SELECT level FROM l WHERE level < ratio ORDER BY ratio, source NULLS LAST LIMIT 1) END AS target
  FROM l),
g AS (
  SELECT m.source, h, sum(size) AS words,
         sum(sum(size)) OVER (PARTITION BY m.source ORDER BY h) AS upto
  FROM m GROUP BY m.source, h)
SELECT m.doc_id, m.source, m.size, t.source_size, t.target,
  (CASE WHEN t.source_size = 0 THEN 0 ELSE
    floor(t.target + 1e-6)::BIGINT // t.source_size * m.size
    + CASE WHEN g.upto <= floor(t.target + 1e-6)::BIGINT % t.source_size THEN m.size
           WHEN g.upto - g.words > floor(t.target + 1e-6)::BIGINT % t.source_size THEN 0
           WHEN m.copy <= floor((floor(t.target + 1e-6)::BIGINT % t.source_size - g.upto + g.words) / m.size::DOUBLE + 0.5) THEN m.size
           ELSE 0 END END)::BIGINT AS taken
FROM m JOIN t ON m.source IS NOT DISTINCT FROM t.source
JOIN g ON m.source IS NOT DISTINCT FROM g.source AND m.h = g.h
"""
