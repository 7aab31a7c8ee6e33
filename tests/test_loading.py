"""Outcomes of files against loads one by one, and loads onto stored relations against one load of everything."""

import random

import pytest

from gradeweave.operators.acceptance import Claims, file_outcomes
from gradeweave.operators.ingest import Ingested
from gradeweave.plans import loading
from gradeweave.plans.loading import add_reports
from gradeweave.plans.reports import RoomPlan
from gradeweave.sources.reports import report_files
from gradeweave.sources.schemas import SCHEMAS

CID = "CID,TERM,SUBJ,CRSE,SEC,UNITS"
MEET = "INSTRUCTOR(S),TYPE,DAYS,TIME,BUILD,ROOM"
SEAT = "SEAT,SID,SURNAME,PREFNAME,LEVEL,UNITS,CLASS,MAJOR,GRADE,STATUS,EMAIL"


def lines(sections):
    """Sections are (term, cid, [(sid, email)], meeting line)."""
    out = []
    for term, cid, seats, *meeting in sections:
        out += [CID, f"{cid},{term},ABC,{cid},1,4", MEET, *meeting, SEAT]
        out += [f"{i},{'' if sid is None else sid},S{sid},P,SO,4,SO,ABC1,A,RE,{email}" for i, (sid, email) in enumerate(seats)]
    return "\n".join(out) + "\n"


def one_by_one(files, courses=(), students=()):
    """What entering the rows of one file after the other gives: file -> (accepted, rule, section, term, cid, sid)."""
    courses, students, out = set(courses), dict(students), {}
    for name, sections in sorted(files.items()):
        mine, people, seated, breach = set(courses), dict(students), set(), None
        kept = [(k, s) for k, s in enumerate(sections, 1) if s[2] or k == len(sections)]
        for k, (term, cid, *_) in kept:
            if breach is None and cid == "":
                breach = ("missing cid", k, term, None, None)
            elif breach is None and (term, cid) in mine:
                breach = ("duplicate term, cid", k, term, cid, None)
            mine.add((term, cid))
        for k, (term, cid, seats, *_) in kept:
            for sid, email in seats:
                if breach:
                    break
                if sid is None:
                    breach = ("missing sid", k, term, cid, None)
                elif sid not in people and email in people.values():
                    breach = ("orphan sid in student", k, term, cid, sid)
                elif (sid, term, cid) in seated:
                    breach = ("duplicate sid, term, cid", k, term, cid, sid)
                people.setdefault(sid, email)
                seated.add((sid, term, cid))
        if breach is None:
            courses, students = mine, people
        out[name] = (breach is None, *(breach or (None,) * 5))
    return out


def outcomes(spark, folder, files, courses=(), students=()):
    folder.mkdir()
    for name, sections in files.items():
        (folder / name).write_text(lines(sections))
    book = Ingested.from_files(spark, str(folder))
    stored = (spark.createDataFrame(list(courses), "term string, cid int"), spark.createDataFrame(list(students), "sid long, email string"))
    got = file_outcomes(Claims.of(book.rows, book.sections), report_files(spark, str(folder)).select("file"), *stored).collect()
    return {r.file.rpartition("/")[2]: tuple(r)[1:] for r in got}


def test_chains_of_files(spark, tmp_path):
    """b falls to a, so c, which only b would reject, stays; the same along e-mails, and from what is stored."""
    files = {
        "a": [("t1", 1, [(1, "x")])], "b": [("t1", 1, [(2, "y")]), ("t1", 2, [(3, "z")])], "c": [("t1", 2, [(4, "w")])],
        "d": [("t2", 1, [(5, "x")])], "e": [("t2", 1, [(5, "v"), (6, "u")])], "f": [("t2", 2, [(7, "v")])], "g": [("t3", 1, [(7, "q"), (8, "v")])],
        "h": [("t4", 1, [(9, ""), (10, "")])], "i": [("t4", 1, [(9, "")])], "j": [("t5", 9, [(11, "k")])], "k": [("t5", 1, [(20, "m"), (21, "k")])],
        "l": [("t6", 1, [(1, "a"), (1, "b")])], "m": [("t6", 1, [(None, "n")])], "n": [("t6", 3, []), ("t6", "", [(12, "o")]), ("t6", 4, [(12, "o")])],
    }
    stored = [("t5", 9)], [(20, "k")]
    got = outcomes(spark, tmp_path / "in", files, *stored)
    assert got == one_by_one(files, *stored)
    assert [f for f, r in sorted(got.items()) if r[0]] == ["a", "c", "e", "i"]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_files(spark, tmp_path, seed):
    rng = random.Random(seed)
    mail = {s: rng.choice("abcdefgh") + str(s // 3) for s in range(40)}
    files = {}
    for k in range(24):
        seats = lambda: [(s, mail[s] if rng.random() < 0.8 else rng.choice("abc")) for s in rng.sample(range(40), rng.randint(0, 4))]
        files[f"f{k:02d}"] = [(f"t{rng.randint(0, 6)}", rng.randint(1, 9), seats()) for _ in range(rng.randint(1, 3))]
    stored = [("t0", 1)], [(0, mail[0]), (1, "zz")]
    assert outcomes(spark, tmp_path / "in", files, *stored) == one_by_one(files, *stored)


def term_file(term, cids, start):
    room = lambda c: f'"Doe, {c % 3}",Lecture,MW,{8 + c % 2}:00 AM - {9 + c % 2}:30 AM,HAL,{c % 2 + 1}'
    return [(term, c, [(start + 50 * c + i, f"{start + 50 * c + i}@x") for i in range(c + int(term[-1]))], room(c)) for c in cids]


FILES = {"a": term_file("200101", [1, 2], 0), "b": term_file("200106", [1, 2, 3], 0), "c": term_file("200106", [3, 4], 0),
         "d": term_file("199906", [1, 2, 5], 0), "e": term_file("200203", [6], 0), "f": term_file("199903", [7], 0)}


def write(folder, names):
    folder.mkdir(exist_ok=True)
    for name in names:
        (folder / name).write_text(lines(FILES[name]))


def tables(stored):
    found = {n: sorted((tuple(r) for r in getattr(stored, n).collect()), key=str) for n in SCHEMAS}
    kept = {(r.file.rpartition("/")[2], r.accepted, r.rule, r.section, r.term, r.cid, r.sid) for r in stored.manifest.collect()}
    return found, kept


def test_three_loads_are_one(spark, tmp_path):
    write(tmp_path / "all", "abcdef")
    whole = add_reports(spark, str(tmp_path / "all"), str(tmp_path / "one"))
    want, outcome = tables(whole)
    assert [x[:3] for x in sorted(outcome) if not x[1]] == [("c", False, "duplicate term, cid")]
    root = str(tmp_path / "three")
    for names in ("a", "bc", "def"):
        write(tmp_path / "in", names)
        stored = add_reports(spark, str(tmp_path / "in"), root)
    assert tables(stored) == (want, outcome)
    plan = RoomPlan(stored, stored.enroll)
    assert {r.term for r in plan.excluded_terms.collect()} == {"199906"}
    assert sorted(map(tuple, plan.capacity.collect())) == sorted(map(tuple, stored.roomcap.collect()))
    again = add_reports(spark, str(tmp_path / "in"), root)
    assert tables(again) == (want, outcome) and again.load.count() == 3


def test_a_broken_load_is_finished(spark, tmp_path, monkeypatch):
    write(tmp_path / "in", "abcdef")
    want, outcome = tables(add_reports(spark, str(tmp_path / "in"), str(tmp_path / "one")))
    root = str(tmp_path / "two")
    write(tmp_path / "part", "ab")
    add_reports(spark, str(tmp_path / "part"), root)
    with monkeypatch.context() as m:
        def broken(*_):
            raise RuntimeError("lost")
        m.setattr(loading, "keep_capacities", broken)
        write(tmp_path / "part", "cdef")
        with pytest.raises(RuntimeError):
            add_reports(spark, str(tmp_path / "part"), root)
    stored = add_reports(spark, str(tmp_path / "part"), root)
    assert tables(stored) == (want, outcome) and stored.load.count() == 2


def test_only_touched_terms_are_read(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "tables")
    write(tmp_path / "in", "abd")
    add_reports(spark, str(tmp_path / "in"), root)
    plans, peaks = [], loading.room_peaks

    def seen(enroll, *rest):
        plans.append(enroll._jdf.queryExecution().executedPlan().toString())
        return peaks(enroll, *rest)

    monkeypatch.setattr(loading, "room_peaks", seen)
    write(tmp_path / "in", "e")
    stored = add_reports(spark, str(tmp_path / "in"), root)
    assert len(plans) == 1 and "PartitionFilters: [isnotnull(term" in plans[0] and "200203" in plans[0]
    assert stored.manifest.count() == 4 and stored.enroll.where("term = '200203'").count() == 9
