"""Student histories: transfers between majors and likely prerequisites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeweave.sources.shared import stage

TARGETS = (("ABC", "203"), ("ABC", "210"), ("ABC", "222"))

# Bucket labels with their exclusive lower bounds.
BUCKETS = ((">95%", 0.95), (">90%", 0.90), (">85%", 0.85), (">80%", 0.80), (">75%", 0.75))


def term_numbers(df: DataFrame) -> DataFrame:
    """Terms of ``df`` with their place in order: a small table, and numbers can be aggregated by hashing."""
    order = Window.orderBy("term")
    return df.select("term").distinct().withColumn("term_number", F.row_number().over(order))


def major_moves(enroll: DataFrame, major_prefix: str = "ABC") -> DataFrame:
    """Per major outside ``major_prefix``: its students, and those seen under the prefix in a later term.

    "An earlier term under this major" is the same as "the first term under it lies before
    the last term under the prefix", so the self-join on student becomes two extremes per
    (student, major): one row each however often a student enrols. These are made before
    anything is shuffled by student alone, so that a crowded student id stays a few rows.
    """
    inside = F.col("major").startswith(major_prefix)
    known = enroll.where(F.col("major").isNotNull() & F.col("sid").isNotNull())
    spans = known.join(term_numbers(enroll), "term").groupBy("sid", "major").agg(
        F.min("term_number").alias("first_term"), F.max("term_number").alias("last_term")
    )
    joined = F.max(F.when(inside, F.col("last_term"))).over(Window.partitionBy("sid"))
    return (
        spans.withColumn("joined", joined).where(~inside)
        .groupBy("major")
        .agg(
            F.count(F.when(F.col("first_term") < F.col("joined"), F.lit(1))).alias("transfers"),
            F.count("*").alias("students"),
        )
        .where(F.col("transfers") > 0)
    )


def transfer_rate(enroll: DataFrame, student: DataFrame, major_prefix: str = "ABC") -> DataFrame:
    """Transfers over all students; a student with two earlier majors counts twice."""
    students = student.agg(F.count("*")).scalar()
    moved = major_moves(enroll, major_prefix).agg(F.coalesce(F.sum("transfers"), F.lit(0)).alias("transfers"))
    return moved.select(F.try_divide(F.col("transfers").cast("double"), students).alias("rate"))


def transfer_by_major(enroll: DataFrame, major_prefix: str = "ABC", top: int | None = 5) -> DataFrame:
    """Share of a major's students who transfer, highest first."""
    ranked = (
        major_moves(enroll, major_prefix)
        .select("major", (F.col("transfers") / F.col("students")).alias("share"))
        .orderBy(F.col("share").desc(), "major")
    )
    return ranked if top is None else ranked.limit(top)


def prereq_share(
    enroll: DataFrame,
    course: DataFrame,
    targets: Sequence[tuple[str, str]] = TARGETS,
    at_least: float | None = None,
) -> DataFrame:
    """Per target course: share of its takers who took each course in an earlier term.

    One row per (student, course) carries the first and last term. A student's last term
    in every target is spread over their rows by a window on the student, so all targets
    are answered in one pass without joining enrolments to themselves.
    """
    taken = (
        enroll.join(course.select("term", "cid", "subj", "crse").join(term_numbers(course), "term"), ["term", "cid"])
        .where(F.col("sid").isNotNull())
        .groupBy("sid", "subj", "crse")
        .agg(F.min("term_number").alias("first_term"), F.max("term_number").alias("last_term"))
    )
    student = Window.partitionBy("sid")
    attempts = [F.max(F.when(_is(t), F.col("last_term"))).over(student).alias(f"attempt_{i}")
                for i, t in enumerate(targets)]
    spread = taken.select("subj", "crse", "first_term", *attempts)
    options = F.array(*[
        F.struct(
            F.lit(t[0]).alias("target_subj"),
            F.lit(t[1]).alias("target_crse"),
            F.coalesce(F.col("first_term") < F.col(f"attempt_{i}"), F.lit(False)).alias("before"),
            F.coalesce(_is(t), F.lit(False)).alias("taker"),
        )
        for i, t in enumerate(targets)
    ])
    useful = F.filter(options, lambda o: o["before"] | o["taker"])
    keys = ["target_subj", "target_crse"]
    counts = (
        spread.select("subj", "crse", F.inline(useful))
        .groupBy(*keys, "subj", "crse")
        .agg(F.count(F.when(F.col("before"), F.lit(1))).alias("had"),
             F.count(F.when(F.col("taker"), F.lit(1))).alias("takers"))
    )
    shares = (
        counts.withColumn("takers", F.sum("takers").over(Window.partitionBy(*keys)))
        .where(F.col("had") > 0)
        .select(*keys, "subj", "crse", (F.col("had") / F.col("takers")).alias("share"))
    )
    return shares if at_least is None else shares.where(F.col("share") >= at_least)


def prereq_share_of(
    enroll: DataFrame,
    course: DataFrame,
    targets: DataFrame | None = None,
    at_least: float | None = None,
) -> DataFrame:
    """The same for a table of targets (subj, crse) of any size, or for every course.

    Histories are one row per (student, course), so one student is no more rows than there are
    courses, however often they enrol. Each of a student's target rows meets that student's rows that
    begin earlier; the pairs are counted where they arise, and only counts per pair of courses are
    shuffled. The counts are as many as there are pairs of courses that somebody took in that order.
    """
    taken = stage(
        enroll.join(course.select("term", "cid", "subj", "crse").join(term_numbers(course), "term"), ["term", "cid"])
        .where(F.col("sid").isNotNull()).groupBy("sid", "subj", "crse")
        .agg(F.min("term_number").alias("first_term"), F.max("term_number").alias("last_term")), "histories")
    attempts = taken if targets is None else taken.join(targets.select("subj", "crse").distinct(), ["subj", "crse"], "left_semi")
    attempts = attempts.select("sid", F.col("subj").alias("target_subj"), F.col("crse").alias("target_crse"), "last_term")
    keys = ["target_subj", "target_crse"]
    takers = attempts.groupBy(*keys).agg(F.count("*").alias("takers"))
    had = (
        taken.select("sid", "subj", "crse", "first_term").join(attempts, "sid").where(F.col("first_term") < F.col("last_term"))
        .groupBy(*keys, "subj", "crse").agg(F.count("*").alias("had"))
    )
    shares = had.join(takers, keys).select(*keys, "subj", "crse", (F.col("had") / F.col("takers")).alias("share"))
    return shares if at_least is None else shares.where(F.col("share") >= at_least)


def prereq_buckets(shares: DataFrame, digits: int = 3) -> DataFrame:
    """Bucket label per share, bounds exclusive; shares of exactly the lowest bound fall in none."""
    label = F.lit(None).cast("string")
    for name, bound in reversed(BUCKETS):
        label = F.when(F.col("share") > bound, F.lit(name)).otherwise(label)
    return (
        shares.withColumn("bucket", label).where(F.col("bucket").isNotNull())
        .orderBy("target_subj", "target_crse", F.col("bucket").desc(), F.col("share").desc(), "subj", "crse")
        .select("target_subj", "target_crse", "bucket", "subj", "crse", F.round("share", digits).alias("share"))
    )


def _is(target: tuple[str, str]) -> Column:
    return (F.col("subj") == target[0]) & (F.col("crse") == target[1])
