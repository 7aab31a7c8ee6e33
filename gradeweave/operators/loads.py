"""Unit loads: how many units students take in a term, and how they fare."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeweave.functions.grades import gpa_sums

LOADS = (1, 20)


def course_terms(course: DataFrame) -> DataFrame:
    return course.select("term").distinct()


def unit_load_share(
    enroll: DataFrame, course: DataFrame, subjects: Sequence[str] = ("ABC", "DEF"), loads: tuple[int, int] = LOADS
) -> DataFrame:
    """Per load u: share of a term's students whose units in ``subjects`` sum to u, averaged over all course terms.

    Students are counted from the same per-student sums, so enrolments are read and shuffled once.
    """
    units = F.when(F.col("subj").isin(*subjects), F.col("units_gained"))
    students = (
        enroll.where(F.col("sid").isNotNull())
        .join(course.select("term", "cid", "subj"), ["term", "cid"])
        .groupBy("term", "sid").agg(F.sum(units).alias("units"))
    )
    counts = students.groupBy("term", "units").agg(F.count("*").alias("n"))
    shares = (
        counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("term")))
        .groupBy("units").agg(F.sum("share").alias("total"))
    )
    terms = course_terms(course).agg(F.count("*")).scalar()
    return _all_loads(enroll, loads).join(shares, "units", "left").select(
        "units", (F.coalesce(F.col("total"), F.lit(0.0)) / terms).alias("share")
    )


def gpa_by_unit_load(enroll: DataFrame, denominator: str = "report", loads: tuple[int, int] = LOADS) -> DataFrame:
    """GPA by a student's total units in a term, all subjects.

    ``denominator="report"`` divides by graded units plus the number of enrolments (a
    GPA that is too low, kept because it is the report's definition); ``"units"`` divides
    by graded units only. All parts add up per student, so no join back is needed. Rows of
    unknown students are left out: they are not one student.
    """
    if denominator not in ("report", "units"):
        raise ValueError(f"denominator must be 'report' or 'units', not {denominator!r}")
    students = enroll.where(F.col("sid").isNotNull()).groupBy("term", "sid").agg(
        F.sum("units_gained").alias("units"),
        F.count("*").alias("enrolments"),
        *gpa_sums(F.col("grade"), F.col("units_gained")),
    )
    totals = students.groupBy("units").agg(
        F.sum("tenths").alias("tenths"), F.sum("graded_units").alias("graded"), F.sum("enrolments").alias("enrolments")
    )
    weight = F.coalesce(F.col("graded"), F.lit(0))
    if denominator == "report":
        weight = weight + F.coalesce(F.col("enrolments"), F.lit(0))
    gpa = F.try_divide(F.coalesce(F.col("tenths"), F.lit(0)).cast("double"), weight * F.lit(10.0))
    return _all_loads(enroll, loads).join(totals, "units", "left").select(
        "units", F.coalesce(gpa, F.lit(0.0)).alias("gpa")
    )


def _all_loads(df: DataFrame, loads: tuple[int, int]) -> DataFrame:
    lo, hi = loads
    return df.sparkSession.range(lo, hi + 1, numPartitions=1).select(F.col("id").alias("units"))
