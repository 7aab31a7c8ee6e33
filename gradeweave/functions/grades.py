"""Grades as columns: grade points, letter test, unit-weighted GPA sums."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grade points in tenths, so that sums stay exact integers.
GRADE_TENTHS = {
    "A+": 40, "A": 40, "A-": 37,
    "B+": 33, "B": 30, "B-": 27,
    "C+": 23, "C": 20, "C-": 17,
    "D+": 13, "D": 10, "D-": 7,
    "F": 0,
}

# Weight of one ungraded row in a GPA denominator (fixed value); it only guards against zero.
UNGRADED_WEIGHT = 0.00000001


def grade_tenths(grade: Column) -> Column:
    """Grade points in tenths; NULL for anything that is not one of the 13 letters."""
    points = F.create_map(*[F.lit(x) for x in chain.from_iterable(GRADE_TENTHS.items())])
    return F.try_element_at(points, grade)


def is_letter(grade: Column) -> Column:
    """Letter-graded by first character A-D, or exactly F. NULL grades are not letters."""
    return F.coalesce(F.substring(grade, 1, 1).isin("A", "B", "C", "D") | (grade == "F"), F.lit(False))


def is_pass(grade: Column) -> Column:
    return grade.isin("P", "S")


def gpa_sums(grade: Column, units: Column) -> list[Column]:
    """Additive parts of a GPA: they may be summed again over any coarser group."""
    tenths = grade_tenths(grade)
    return [
        F.sum(tenths * units).alias("tenths"),
        F.sum(F.when(tenths.isNotNull(), units)).alias("graded_units"),
        F.count(F.when(tenths.isNull(), F.lit(1))).alias("ungraded"),
    ]


def resum_gpa() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("tenths", "graded_units", "ungraded")]


def gpa_value(ungraded_weight: float) -> Column:
    """GPA from summed parts; NULL where the denominator is zero or no units are known.

    One division of whole tenths, so that equal GPAs are equal doubles and tie on purpose.
    """
    weight = F.coalesce(F.col("graded_units"), F.lit(0)) + F.col("ungraded") * F.lit(float(ungraded_weight))
    return F.try_divide(F.coalesce(F.col("tenths"), F.lit(0)).cast("double"), weight * F.lit(10.0))
