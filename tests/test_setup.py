"""Report files to stored relations and reports on them."""

import pytest
from pyspark.sql import functions as F

from gradeweave.__main__ import main
from gradeweave.operators import gpa
from gradeweave.plans.reports import RoomPlan, fixed_reports
from gradeweave.plans.setup import load_reports, table_quality
from gradeweave.sources.schemas import SCHEMAS


def report(term, sizes):
    lines = []
    for cid, (room, size) in enumerate(sizes, 1):
        lines += ["CID,TERM,SUBJ,CRSE,SEC,UNITS", f"{cid},{term},ABC,10{cid},1,4",
                  "INSTRUCTOR(S),TYPE,DAYS,TIME,BUILD,ROOM", f'"Doe, {cid}",Lecture,MW,8:00 AM - 8:50 AM,HAL,{room}',
                  "SEAT,SID,SURNAME,PREFNAME,LEVEL,UNITS,CLASS,MAJOR,GRADE,STATUS,EMAIL"]
        lines += [f"{i},{100 * cid + i},Roe,Sam,SO,4,SO,ABC1,{'A' if i % 2 else ''},RE,{100 * cid + i}@x" for i in range(1, size + 1)]
    return "\n".join(lines) + "\n"


def test_load_and_report(spark, tmp_path):
    reports, root = tmp_path / "in", tmp_path / "tables"
    reports.mkdir()
    (reports / "a.csv").write_text(report("200101", [(1, 3), (2, 6)]))
    (reports / "b.csv").write_text(report("200103", [(3, 20), (4, 5)]))
    stored = load_reports(spark, str(reports), str(root))
    for name, schema in SCHEMAS.items():
        got = {f.name: f.dataType.simpleString() for f in getattr(stored, name).schema}
        assert got == {c: t for c, t in (f.split() for f in schema.split(", "))}, name
    assert {r.term for r in stored.enroll.select("term").distinct().collect()} == {"200101", "200103"}
    assert stored.enroll.where("grade = ''").count() == 1 + 3 + 10 + 2
    assert stored.enroll.where("grade is null").count() == 0
    assert {tuple(r) for r in stored.roomcap.select("room", "capacity").collect()} == {(1, 3), (2, 6), (3, 20), (4, 5)}
    assert table_quality(stored).where(F.col("violations") > 0).count() == 0
    for name, run in fixed_reports(stored).items():
        assert run().columns, name
        run().collect()
    opened = RoomPlan(stored, stored.enroll).open_rooms("200101", 1, 2, capacity=stored.roomcap)
    assert sorted((r.room, r.cap, r.filled) for r in opened.collect()) == [(3, 20, 3), (4, 5, 3)]
    assert gpa.instructor_extremes(stored.enroll, stored.course, stored.meeting).first().lowest == 4.0


def test_terms_are_pruned(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(report("200101", [(1, 3)]))
    stored = load_reports(spark, str(tmp_path / "in"), str(tmp_path / "tables"))
    plan = RoomPlan(stored, stored.enroll).open_rooms("200101", 1, 2, capacity=stored.roomcap)
    text = plan._jdf.queryExecution().optimizedPlan().toString() + plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(term" in text


def test_reports_and_issues_are_whole(spark, tmp_path, capsys):
    text = "".join(report("200101", [(1, 2)]).replace("1,200101,ABC,101", f"{i},200101,ABC,1{i:03d}").replace("Doe, 1", f"Doe, {i % 3}")
                   for i in range(150))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(text + "1,2\n")
    root, out = str(tmp_path / "tables"), str(tmp_path / "out")
    main(["setup", str(tmp_path / "in"), root])
    assert "short_row\t1" in capsys.readouterr().out
    main(["reports", root, out])
    assert spark.read.csv(f"{out}/course_gpa_extremes", header=True).count() == 150


def test_open_quotes_stop_the_setup(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(report("200101", [(1, 3)]) + '9,"never closed\nmore\n')
    with pytest.raises(ValueError, match="never closed"):
        load_reports(spark, str(tmp_path / "in"), str(tmp_path / "tables"))
    stored = load_reports(spark, str(tmp_path / "in"), str(tmp_path / "tables"), go_on=True)
    assert stored.rejected_line.count() == 2 and stored.enroll.count() == 3
    assert [tuple(r) for r in stored.issue.select("rule").collect()] == [("record_not_closed",)]


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(report("200101", [(1, 3)]) + report("200103", [(2, 9)]))
    root = str(tmp_path / "tables")
    main(["setup", str(tmp_path / "in"), root])
    main(["reports", root, str(tmp_path / "out"), "--print"])
    main(["open-rooms", root, "200101", "1", "2"])
    shown = capsys.readouterr().out
    assert spark.read.csv(str(tmp_path / "out" / "gpa_by_unit_load"), header=True).count() == 20
    assert "instructor_extremes" in shown and "|  HAL|   2|  9|     3|" in shown
