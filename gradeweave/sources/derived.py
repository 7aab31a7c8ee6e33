"""The seven gradebook relations, derived from lineitem, orders and customer.

Only integer arithmetic and comparisons are used, so that any SQL engine gives the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeweave.operators.ordered import number_rows
from gradeweave.sources.shared import stage

# Fixed values of the derivation.
GRADES = ["A+", "A", "A-", "B+", "B", "B-", "C+", "C", "C-", "D+", "D", "D-", "F", "P", "S", "NP", ""]
SPECIAL_CRSE = {0: "203", 1: "210", 2: "222"}
ABC_IDX = [0, 1, 2, 3, 4, 5, 10, 11, 12]
DEF_IDX = [6, 7, 13, 14]
BUILDINGS = ["HAL", "OLS", "WEL"]


# Rows that are given out once more with one column changed, by table: which rows, and the columns that
# become unknown, too wide, or point nowhere. Every rule of the quality report is broken by some.
SPOILED = {
    "course": ("idx = 1", ["term", "cid"], ["term", "subj", "crse"], {}),
    "instructor": ("full_name LIKE '%7'", ["full_name"], ["full_name"], {}),
    "meeting": ("pos = 2", ["term", "cid"], ["build", "typ"], {"full_name": "'Nobody'", "cid": "-1"}),
    "daytime": ("day = 'F'", ["term", "cid", "pos"], ["day"], {"pos": "9"}),
    "student": ("sid % 7 = 0", ["sid"], ["prefname", "surname", "email"], {}),
    "enroll": ("sid % 5 = 0", ["sid", "term", "cid"], ["term", "status", "class", "major", "level", "grade"], {"sid": "-1", "cid": "-1"}),
    "roomcap": ("room = 103", ["build", "room"], ["build"], {}),
}
WIDE = "x" * 400


def spoiled(name: str, df: DataFrame) -> DataFrame:
    """The rows of ``df``, and some again that break each of its rules; all of these also repeat their keys."""
    which, unknown, wide, astray = SPOILED[name]
    some, types = df.where(which), dict(df.dtypes)
    changes = [{c: F.lit(None)} for c in unknown] + [{c: F.lit(WIDE)} for c in wide] + [{c: F.expr(v)} for c, v in astray.items()]
    for change in changes:
        df = df.unionByName(some.withColumns({c: v.cast(types[c]) for c, v in change.items()}))
    return df.unionByName(some)


@dataclass(frozen=True)
class Derived:
    """Relations over one folder of test tables; all lazy unless ``staged_course``."""

    spark: SparkSession
    sf_dir: str
    staged_course: bool = False

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def base(self) -> DataFrame:
        """One row per line item, as one seat in one section. Staged: most reports need it more than once."""
        return stage(self._seats(), "seats")

    def _seats(self) -> DataFrame:
        part = F.col("l_partkey") % 40
        idx = (
            F.when(part < 8, 0).when(part < 14, 1).when(part < 19, 2).when(part < 23, 3).when(part < 26, 4)
            .otherwise(5 + F.col("l_partkey") % 13).cast("int")
        )
        month, yr = F.month("o_orderdate"), F.year("o_orderdate")
        mm = F.when(month <= 3, 1).when(month <= 6, 3).when(month <= 8, 6).otherwise(10)
        return (
            self._read("lineitem")
            .join(self._read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self._read("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .select(
                F.col("o_custkey").alias("sid"),
                (F.col("l_orderkey") * 7 + F.col("l_partkey") * 3 + F.col("l_linenumber")).alias("k"),
                F.col("c_mktsegment").alias("seg"),
                yr.alias("yr"),
                (yr * 100 + mm).cast("string").alias("term"),
                idx.alias("idx"),
                (F.col("l_suppkey") % 2 + 1).cast("int").alias("sec"),
            )
            .withColumn("cid", (10000 + F.col("idx") * 10 + F.col("sec")).cast("int"))
        )

    @cached_property
    def course(self) -> DataFrame:
        idx = F.col("idx")
        even = idx % 2 == 0
        crse = F.coalesce(*[F.when(idx == i, F.lit(c)) for i, c in SPECIAL_CRSE.items()], (100 + idx).cast("string"))
        sections = self.base.select("term", "cid", "idx", "sec", "yr").distinct().select(
            "term", "cid", "idx", "sec", "yr",
            F.when(idx.isin(ABC_IDX), "ABC").when(idx.isin(DEF_IDX), "DEF").otherwise("GHI").alias("subj"),
            crse.alias("crse"),
            F.when(even, F.lit(1)).alias("min_units"),
            F.when(even, F.lit(5)).alias("max_units"),
        )
        return stage(sections, "course") if self.staged_course else sections

    @cached_property
    def enroll_unnumbered(self) -> DataFrame:
        """Enrolments with the student as seat label: enough wherever seats are only counted."""
        k, sid = F.col("k"), F.col("sid")
        grades = F.array(*[F.lit(g) for g in GRADES])
        major = F.when(
            (sid % 5 == 0) & (F.col("yr") >= 1998), F.concat(F.lit("ABC"), (sid % 3).cast("string"))
        ).otherwise(F.concat(F.substring("seg", 1, 3), F.lit("1")))
        return (
            self.base.groupBy("sid", "seg", "term", "yr", "cid")  # a student has one segment, a term one year
            .agg(F.min("k").alias("k"))
            .select(*self._enroll_columns(k, sid, grades, major), sid.alias("seat"))
        )

    @cached_property
    def enroll(self) -> DataFrame:
        """Enrolments with seats numbered 1..n per section by student. Staged before, as numbering takes its rows twice."""
        return number_rows(stage(self.enroll_unnumbered.drop("seat"), "enrolments"), ["term", "cid"], "sid", "seat")

    @cached_property
    def raw_seats(self) -> DataFrame:
        """One enrolment per line item, before repeated (student, section) rows are merged."""
        k, sid = F.col("k"), F.col("sid")
        grades = F.array(*[F.lit(g) for g in GRADES])
        return self.base.select(*self._enroll_columns(k, sid, grades, F.concat(F.substring("seg", 1, 3), F.lit("1"))),
                                F.lit(None).cast("bigint").alias("seat"))

    @staticmethod
    def _enroll_columns(k: Column, sid: Column, grades: Column, major: Column) -> list[Column]:
        return [
            sid, F.col("term"), F.col("cid"),
            F.when(k % 29 != 0, 1 + k % 5).alias("units_gained"),
            F.when(k % 11 == 0, "").otherwise("RE").alias("status"),
            F.lit("SO").alias("class"),
            major.alias("major"),
            F.lit("SO").alias("level"),
            F.get(grades, (k % 17).cast("int")).alias("grade"),
        ]

    @cached_property
    def meeting(self) -> DataFrame:
        idx, yr, sec = F.col("idx"), F.col("yr"), F.col("sec")
        teacher = F.concat(F.lit("Supplier#"), F.lpad(((idx * 7 + yr + sec) % 10).cast("string"), 9, "0"))
        st = 60 * (480 + 60 * ((idx + yr) % 6) + 10 * (yr % 3)) + 30 * (idx % 2)
        lecture = F.struct(
            F.lit(1).alias("pos"), F.lit("Lecture").alias("typ"),
            F.when(idx % 2 == 0, "MWF").otherwise("TR").alias("days"),
            st.cast("int").alias("st"), (st + 60 * (50 + 40 * sec)).cast("int").alias("en"),
        )
        lab = F.struct(
            F.lit(2).alias("pos"), F.lit("Lab").alias("typ"), F.lit("F").alias("days"),
            F.lit(None).cast("int").alias("st"), F.lit(None).cast("int").alias("en"),
        )
        held = F.when(idx % 4 == 0, F.array(lecture, lab)).otherwise(F.array(lecture))
        return self.course.select(
            "term", "cid",
            teacher.alias("full_name"),
            F.get(F.array(*[F.lit(b) for b in BUILDINGS]), idx % 3).alias("build"),
            (100 + (idx * 2 + yr) % 12).cast("int").alias("room"),
            F.inline(held),
        )

    @cached_property
    def daytime(self) -> DataFrame:
        day = F.explode(F.filter(F.split("days", ""), lambda d: d != ""))
        return self.meeting.select("term", "cid", "pos", day.alias("day"), "st", "en")

    @cached_property
    def student(self) -> DataFrame:
        return self._read("customer").select(
            F.col("c_custkey").alias("sid"),
            F.col("c_mktsegment").alias("prefname"),
            F.col("c_name").alias("surname"),
            F.concat(F.lower("c_name"), F.lit("@example.edu")).alias("email"),
        )

    @cached_property
    def instructor(self) -> DataFrame:
        return self.meeting.select("full_name").distinct()
