"""Reports on small literal relations, for rules the test tables do not reach."""

import itertools
import random

import pytest

from gradeweave.operators import cohorts, gpa, loads
from gradeweave.operators.ordered import number_rows
from gradeweave.operators.quality import quality_report

ENROLL = "sid int, term string, cid int, units_gained int, grade string, major string"
COURSE = "term string, cid int, subj string, crse string"
MEETING = "term string, cid int, full_name string"


def frames(spark, enroll, course, meeting=()):
    wide = [(*row, "XX")[:6] for row in enroll]
    return (spark.createDataFrame(wide, ENROLL), spark.createDataFrame(list(course), COURSE),
            spark.createDataFrame(list(meeting), MEETING))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


COURSES = [("t1", 1, "ABC", "101"), ("t1", 2, "ABC", "102"), ("t1", 3, "GHI", "101")]
MEETINGS = [("t1", 1, "P"), ("t1", 2, "P"), ("t1", 2, "Q"), ("t1", 3, "R")]


def test_weighted_gpa(spark):
    enroll = [
        (1, "t1", 1, 4, "A"), (2, "t1", 1, 2, "C"),  # (16 + 4) / 6
        (3, "t1", 2, None, "A"), (4, "t1", 2, 3, "AU"), (5, "t1", 2, 5, "P"), (6, "t1", 3, 4, "F"),
    ]
    e, c, m = frames(spark, enroll, COURSES, MEETINGS)
    got = dict(rows(gpa.gpa_by_instructor(e, c, m)))
    assert got["P"] == pytest.approx(20 / 6, abs=1e-6) and got["Q"] == 0 and got["R"] == 0
    # AU counts as a letter without points or weight: nothing left to divide by
    assert rows(gpa.gpa_by_instructor_course(e, c, m)) == [("P", "101", pytest.approx(20 / 6)), ("P", "102", None), ("Q", "102", None)]
    assert rows(gpa.instructor_extremes(e, c, m)) == [("P", 3.33, "P", 3.33)]


def test_enrolment_weighs_once_per_meeting(spark):
    e, c, m = frames(spark, [(1, "t1", 1, 1, "A"), (1, "t1", 2, 1, "F")], COURSES, [("t1", 1, "P"), ("t1", 1, "P"), ("t1", 2, "P")])
    assert rows(gpa.gpa_by_instructor(e, c, m)) == [("P", pytest.approx(8 / 3))]


def test_sentinels_and_ties(spark):
    e, c, m = frames(spark, [(1, "t1", 1, 4, "A"), (2, "t1", 2, 4, "A+")], COURSES, MEETINGS)
    assert rows(gpa.instructor_extremes(e, c, m)) == [("", 4.0, "P", 4.0)]
    df = spark.createDataFrame([("k", "b", 3.3), ("k", "a", 3.3), ("z", "q", None)], "g string, n string, v double")
    assert rows(gpa.extremes(df, "v", "n", 4, 0, by=["g"])) == [("k", "a", 3.3, "a", 3.3), ("z", "", 4.0, "", 0.0)]


def test_pass_rate(spark):
    enroll = [(1, "t1", 1, 4, "P"), (2, "t1", 1, 4, ""), (3, "t1", 1, 4, None), (4, "t1", 1, 4, "A"), (5, "t1", 1, 4, "CR"),
              (6, "t1", 2, 4, "NP"), (7, "t1", 3, 4, "S")]
    e, c, m = frames(spark, enroll, COURSES, MEETINGS)
    assert rows(gpa.pass_rate(e, c, m)) == [("P", "101", 0.5)]
    assert rows(gpa.course_passrate_extremes(e, c, m)) == [("101", "P", 0.5, "P", 0.5)]


def test_unit_loads(spark):
    course = [("t1", 1, "ABC", "1"), ("t1", 2, "GHI", "1"), ("t2", 1, "DEF", "1"), ("t3", 1, "ABC", "1")]
    enroll = [(1, "t1", 1, 4, "A"), (1, "t1", 2, 3, "B"), (2, "t1", 2, 4, "C"), (3, "t2", 1, None, "A"), (4, "t2", 1, 4, "P")]
    e, c, _ = frames(spark, enroll, course)
    share = dict(rows(loads.unit_load_share(e, c)))
    assert len(share) == 20 and share[4] == pytest.approx((1 / 2 + 1 / 2) / 3) and share[7] == 0
    low, right = dict(rows(loads.gpa_by_unit_load(e))), dict(rows(loads.gpa_by_unit_load(e, "units")))
    assert right[7] == pytest.approx(25 / 7) and low[7] == pytest.approx(25 / 9)
    assert right[4] == 2.0 and low[4] == pytest.approx(8 / 6) and low[1] == 0
    with pytest.raises(ValueError):
        loads.gpa_by_unit_load(e, "rows")


def test_unknown_students_are_not_one_student(spark):
    enroll = [(None, "t1", 1, 3, "A", "M"), (None, "t1", 1, 2, "F", "M"), (1, "t1", 1, 5, "B", "M")]
    e, c, _ = frames(spark, enroll, COURSES)
    assert dict(rows(loads.gpa_by_unit_load(e, "units")))[5] == 3
    assert dict(rows(loads.unit_load_share(e, c)))[5] == 1



def test_histories_by_brute_force(spark):
    rng = random.Random(3)
    course = [(t, c, s, n) for t in "abcd" for c, (s, n) in enumerate([("ABC", "203"), ("ABC", "210"), ("GHI", "1"), ("DEF", "2")])]
    enroll = sorted({(rng.randint(1, 25), rng.choice("abcd"), rng.randint(0, 3)) for _ in range(150)})
    enroll = [(*key, 1, "A", rng.choice(["ABC1", "ABC2", "X1", "Y1", ""])) for key in enroll]
    e, c, _ = frames(spark, enroll, course)
    e2 = spark.createDataFrame(enroll, ENROLL)

    moved = {}
    for a, b in itertools.product(enroll, enroll):
        if a[0] == b[0] and b[5].startswith("ABC") and not a[5].startswith("ABC") and b[1] > a[1]:
            moved.setdefault(a[5], set()).add(a[0])
    share = {m: len(s) / len({r[0] for r in enroll if r[5] == m}) for m, s in moved.items()}
    assert dict(rows(cohorts.transfer_by_major(e2))) == pytest.approx(share) and len(share) == 3
    student = spark.range(30).withColumnRenamed("id", "sid")
    assert rows(cohorts.transfer_rate(e2, student))[0][0] == pytest.approx(sum(map(len, moved.values())) / 30)

    of = {(t, i): (s, n) for t, i, s, n in course}
    taken = [(r[0], r[1], *of[r[1], r[2]]) for r in enroll]
    want = {}
    for target in (("ABC", "203"), ("ABC", "210")):
        takers = {r[0] for r in taken if r[2:] == target}
        for other in set(of.values()):
            had = {b[0] for a in taken for b in taken if a[0] == b[0] and a[2:] == target and b[2:] == other and b[1] < a[1]}
            if had:
                want[(*target, *other)] = len(had) / len(takers)
    got = {r[:4]: r[4] for r in rows(cohorts.prereq_share(e, c, targets=[("ABC", "203"), ("ABC", "210")]))}
    assert got == pytest.approx(want) and len(want) == 8
    table = spark.createDataFrame([("ABC", "203"), ("ABC", "210"), ("ABC", "203"), ("XYZ", "1")], "subj string, crse string")
    assert {r[:4]: r[4] for r in rows(cohorts.prereq_share_of(e, c, table))} == pytest.approx(want)
    every = {r[:4]: r[4] for r in rows(cohorts.prereq_share_of(e, c))}
    assert len({k[:2] for k in every}) == 4 and {k: v for k, v in every.items() if k[:2] in (("ABC", "203"), ("ABC", "210"))} == pytest.approx(want)


def test_buckets(spark):
    df = spark.createDataFrame([("T", "1", "S", str(i), s) for i, s in enumerate([0.75, 0.7501, 0.8, 0.951, 0.5, 0.9])],
                               "target_subj string, target_crse string, subj string, crse string, share double")
    got = [(r.bucket, r.crse, r.share) for r in cohorts.prereq_buckets(df).collect()]
    assert got == [(">95%", "3", 0.951), (">85%", "5", 0.9), (">75%", "2", 0.8), (">75%", "1", 0.75)]


def test_quality_rules(spark):
    tables = {
        "course": spark.createDataFrame([("t1", 1, "ABCD", "1"), ("t1", 1, "ABC", "1"), ("t2", None, "A", "1")], COURSE),
        "meeting": spark.createDataFrame([("t1", 1, 1, "P", "HALL", "Lab"), ("t9", 1, 1, "Q", "HAL", "Lab")],
                                         "term string, cid int, pos int, full_name string, build string, typ string"),
        "instructor": spark.createDataFrame([("P",)], "full_name string"),
        "student": spark.createDataFrame([(1, "a", "b", ""), (2, "a", "b", "")], "sid int, prefname string, surname string, email string"),
        "enroll": spark.createDataFrame([(1, "t1", 1, "", "", "X", "", "A")] * 3 + [(8, "t1", 7, "", "", "X", "", "A")],
                                        "sid int, term string, cid int, status string, class string, major string, level string, grade string"),
    }
    got = {(r.table, r.rule): r.violations for r in quality_report(tables).collect()}
    assert {k: n for k, n in got.items() if n} == {
        ("course", "missing cid"): 1, ("course", "too_wide subj"): 1, ("course", "duplicate term, cid"): 1,
        ("meeting", "too_wide build"): 1, ("meeting", "orphan full_name in instructor"): 1,
        ("meeting", "orphan term, cid in course"): 1, ("student", "duplicate email"): 1,
        ("enroll", "duplicate sid, term, cid"): 2, ("enroll", "orphan sid in student"): 1, ("enroll", "orphan term, cid in course"): 1,
    }


def test_number_rows_across_ranges(spark):
    rng = random.Random(1)
    data = [(g, v) for g in "xy" for v in rng.sample(range(-50, 200), 120)]
    df = number_rows(spark.createDataFrame(data, "g string, v bigint"), ["g"], "v", "n", width=16)
    want = [(g, v, i) for g in "xy" for i, v in enumerate(sorted(v for h, v in data if h == g), 1)]
    assert rows(df.select("g", "v", "n")) == want
