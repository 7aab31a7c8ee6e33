"""GPAs, pass rates and their extremes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeweave.functions.grades import (
    UNGRADED_WEIGHT, gpa_sums, gpa_value, is_letter, is_pass, resum_gpa,
)

SECTION = ["term", "cid"]


def weighted_gpa(
    enroll: DataFrame,
    course: DataFrame,
    by: Sequence[str],
    meeting: DataFrame | None = None,
    ungraded_weight: float = UNGRADED_WEIGHT,
) -> DataFrame:
    """Unit-weighted GPA per ``by``.

    Enrolments shrink to one row per section (and per enrolment column in ``by``) before
    anything is joined, so only section-level rows meet courses and meetings. With
    ``meeting`` an enrolment weighs once per meeting of its section.
    """
    kept = [c for c in by if c in enroll.columns and c not in SECTION]
    sums = enroll.groupBy(*SECTION, *kept).agg(*gpa_sums(F.col("grade"), F.col("units_gained")))
    sections = _with_course(sums, course, by, kept)
    if meeting is not None:
        sections = sections.join(meeting.select(*SECTION, "full_name"), SECTION)
    return sections.groupBy(*by).agg(*resum_gpa()).select(*by, gpa_value(ungraded_weight).alias("gpa"))


def gpa_by_instructor(enroll: DataFrame, course: DataFrame, meeting: DataFrame) -> DataFrame:
    return weighted_gpa(enroll, course, ["full_name"], meeting)


def gpa_by_major(enroll: DataFrame, course: DataFrame, subject: str = "ABC") -> DataFrame:
    return weighted_gpa(enroll, course.where(F.col("subj") == subject), ["major"])


def lower_division(course: DataFrame, subject: str = "ABC", crse_prefix: str = "1") -> DataFrame:
    return course.where((F.col("subj") == subject) & F.col("crse").startswith(crse_prefix))


def gpa_by_instructor_course(
    enroll: DataFrame, course: DataFrame, meeting: DataFrame, subject: str = "ABC", crse_prefix: str = "1"
) -> DataFrame:
    """GPA of letter-graded enrolments per (instructor, course number)."""
    letters = enroll.where(is_letter(F.col("grade")))
    return weighted_gpa(
        letters, lower_division(course, subject, crse_prefix), ["full_name", "crse"], meeting, ungraded_weight=0.0
    )


def pass_rate(
    enroll: DataFrame, course: DataFrame, meeting: DataFrame, subject: str = "ABC", crse_prefix: str = "1"
) -> DataFrame:
    """Share of P and S among non-letter enrolments per (instructor, course number); zero rates are left out."""
    grade = F.col("grade")
    sections = enroll.where(~is_letter(grade)).groupBy(*SECTION).agg(
        F.count(F.when(is_pass(grade), F.lit(1))).alias("passed"),
        F.count(grade).alias("counted"),
    )
    return (
        _with_course(sections, lower_division(course, subject, crse_prefix), ["crse"], [])
        .join(meeting.select(*SECTION, "full_name"), SECTION)
        .groupBy("full_name", "crse")
        .agg(F.sum("passed").alias("passed"), F.sum("counted").alias("counted"))
        .select("full_name", "crse", F.try_divide(F.col("passed").cast("double"), F.col("counted")).alias("passrate"))
        .where(F.col("passrate") != 0.0)
    )


def extremes(
    df: DataFrame,
    value: str,
    name: str,
    low_start: float,
    high_start: float,
    by: Sequence[str] = (),
    skip_below: float | None = None,
    digits: int = 2,
) -> DataFrame:
    """Lowest and highest ``value`` with their names, per ``by`` or overall.

    The lowest must be under ``low_start`` and the highest over ``high_start``; where
    nothing is, the name is blank and the start itself is reported. Ties go to the
    alphabetically first name.
    """
    v, n = F.col(value), F.col(name)
    counted: Column = v.isNotNull() if skip_below is None else v >= skip_below
    low = F.min(F.when(counted & (v < low_start), F.struct(v.alias("v"), n.alias("n"))))
    high = F.min(F.when(counted & (v > high_start), F.struct((-v).alias("v"), n.alias("n"))))
    return df.groupBy(*by).agg(low.alias("low"), high.alias("high")).select(
        *by,
        F.coalesce(F.col("low.n"), F.lit("")).alias("lowest_name"),
        F.round(F.coalesce(F.col("low.v"), F.lit(float(low_start))), digits).alias("lowest"),
        F.coalesce(F.col("high.n"), F.lit("")).alias("highest_name"),
        F.round(F.coalesce(-F.col("high.v"), F.lit(float(high_start))), digits).alias("highest"),
    )


def instructor_extremes(enroll: DataFrame, course: DataFrame, meeting: DataFrame) -> DataFrame:
    return extremes(gpa_by_instructor(enroll, course, meeting), "gpa", "full_name", 4, 0, skip_below=0.01)


def major_extremes(enroll: DataFrame, course: DataFrame, subject: str = "ABC") -> DataFrame:
    return extremes(gpa_by_major(enroll, course, subject), "gpa", "major", 4, 0, skip_below=0.01)


def course_gpa_extremes(enroll: DataFrame, course: DataFrame, meeting: DataFrame) -> DataFrame:
    return extremes(gpa_by_instructor_course(enroll, course, meeting), "gpa", "full_name", 4, 0, by=["crse"])


def course_passrate_extremes(enroll: DataFrame, course: DataFrame, meeting: DataFrame) -> DataFrame:
    return extremes(pass_rate(enroll, course, meeting), "passrate", "full_name", 1, 0, by=["crse"])


def _with_course(sections: DataFrame, course: DataFrame, by: Sequence[str], kept: Sequence[str]) -> DataFrame:
    wanted = [c for c in by if c in course.columns and c not in SECTION and c not in kept]
    return sections.join(course.select(*SECTION, *wanted), SECTION)
