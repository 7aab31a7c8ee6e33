"""Room operators against brute force on small random timetables, and rules the test tables do not reach."""

import random

import pytest

from gradeweave.operators import rooms
from gradeweave.plans.reports import RoomPlan

COURSE = "term string, cid int, subj string, crse string"
MEETING = "term string, cid int, pos bigint, full_name string, room int, build string"
DAYTIME = "term string, cid int, pos bigint, day string, st int, en int"
ENROLL = "sid bigint, term string, cid int, seat int"


class Book:
    def __init__(self, spark, course, meeting, daytime, enroll=()):
        self.course = spark.createDataFrame(course, COURSE)
        self.meeting = spark.createDataFrame(meeting, MEETING)
        self.daytime = spark.createDataFrame(daytime, DAYTIME)
        self.enroll = spark.createDataFrame(enroll, ENROLL)


def random_book(seed, backward):
    rng = random.Random(seed)
    course, meeting, daytime = [], [], []
    for cid in range(120):
        term = rng.choice(["199606", "199706", "199701"])
        course.append((term, cid, rng.choice(["ABC", "DEF"]), str(rng.randint(1, 15))))
        for pos in range(rng.randint(1, 2)):
            meeting.append((term, cid, pos, rng.choice("PQRS"), rng.choice([1, 2, None]), rng.choice(["A", "B"])))
            for day in rng.sample("MTWRF", 2):
                st = rng.randrange(28800, 42000, 600) + rng.choice([0, 0, 1, 30])
                en = st + rng.choice([1800, 3000, 4799, 0, -1200, -3600] if backward else [1800, 3000, 4799, 1])
                daytime.append((term, cid, pos, day, *rng.choice([(st, en)] * 9 + [(None, None)])))
    return course, meeting, daytime


def overlaps(course, meeting, daytime):
    """All pairs, by definition."""
    of_course = {(t, c): (s, n) for t, c, s, n in course}
    place = {(t, c, p): (b, r, who) for t, c, p, who, r, b in meeting}
    held = []
    for t, c, p, day, st, en in daytime:
        build, room, who = place[t, c, p]
        if t.endswith("6") and room is not None and st is not None:
            held.append((t, build, room, day, st, en, *of_course[t, c], who))
    return [(a, b) for a in held for b in held
            if a[:4] == b[:4] and a[8] != b[8] and a[7] < b[7] and a[4] < b[5] and a[5] > b[4]]


@pytest.mark.parametrize("seed,backward", [(1, False), (2, True), (3, True)])
def test_conflicts(spark, seed, backward):
    data = random_book(seed, backward)
    pairs = overlaps(*data)
    plan = RoomPlan(Book(spark, *data), None)
    got = {tuple(r)[:8] for r in plan.conflicting.select("term", "build", "room", "day", "st", "en", "subj", "crse").collect()}
    assert got == {a[:8] for a, _ in pairs} and got

    first = {}
    for a, b in pairs:
        pair = (a[0], a[6], a[7], b[6], b[7])
        first[a[4:6]] = min(first.get(a[4:6], pair), pair)
    rows = plan.conflicts.select("st", "en", "term", "subj1", "crse1", "subj2", "crse2").collect()
    assert {(r.st, r.en): tuple(r)[2:] for r in rows} == first and len(rows) == len(first)
    assert {r.term for r in plan.excluded_terms.collect()} == {p[0] for p in first.values()}

    links = {}
    for a, b in set(pairs):
        links.setdefault((*a[:6], *b[4:6]), []).append((a[6], a[7], b[6], b[7]))
    got = {tuple(r)[:8]: tuple(r)[8:] for r in rooms.conflict_links(plan.booked).collect()}
    assert got == {key: (len(found), *min(found)) for key, found in links.items()}


def test_peaks_capacity_and_open_rooms(spark):
    course = [("199601", i, "ABC", str(i)) for i in range(1, 5)] + [("199506", 9, "ABC", "1"), ("199506", 10, "ABC", "2")]
    meeting = [
        ("199601", 1, 1, "P", 1, "A"), ("199601", 2, 1, "P", 1, "A"),  # same room and slot: seats add up
        ("199601", 3, 1, "P", 2, "A"), ("199601", 3, 2, "P", 2, "A"),  # two meetings of one course in one room
        ("199601", 4, 1, "P", 3, "A"),                                 # no days: counts on its own
        ("199506", 9, 1, "P", 4, "A"), ("199506", 10, 1, "Q", 4, "A"),  # conflict: its term is left out
    ]
    daytime = [("199601", 1, 1, "M", None, None), ("199601", 2, 1, "M", None, None),
               ("199601", 3, 1, "M", 480, 530), ("199601", 3, 2, "F", 480, 530),
               ("199506", 9, 1, "M", 480, 530), ("199506", 10, 1, "M", 500, 530)]
    sizes = {("199601", 1): 3, ("199601", 2): 4, ("199601", 3): 5, ("199601", 4): 2, ("199506", 9): 9, ("199506", 10): 1}
    enroll = [(i, t, c, i if i else None) for (t, c), n in sizes.items() for i in range(n + 1)]
    book = Book(spark, course, meeting, daytime, enroll)
    plan = RoomPlan(book, book.enroll)
    assert {tuple(r) for r in plan.peaks.collect()} == {("A", 1, "199601", 7), ("A", 2, "199601", 5), ("A", 3, "199601", 2)}
    capacity = plan.capacity
    assert {tuple(r) for r in capacity.collect()} == {("A", 1, 7), ("A", 2, 5), ("A", 3, 2), ("A", 4, None)}

    def opened(cid, extra, term="199601", caps=(("B", 8, 9), ("B", 7, 6), ("A", 1, 50)), **options):
        table = spark.createDataFrame(list(caps), "build string, room int, capacity bigint")
        return sorted(tuple(r) for r in plan.open_rooms(term, cid, extra, capacity=table, **options).collect())

    assert opened(3, 1) == [("B", 7, 6, 5)] * 2 + [("B", 8, 9, 5)] * 2
    assert opened(3, 1, distinct=True) == [("B", 7, 6, 5), ("B", 8, 9, 5)]
    assert opened(3, 2) == [("B", 8, 9, 5)] * 2
    assert opened(3, 5) == [] and opened(77, 1) == [] and opened(9, 0, term="199506") == []
    assert opened(1, 2) == [("B", 8, 9, 7)]
    top = rooms.smallest_rooms(plan.open_rooms("199601", 3, 1, capacity=spark.createDataFrame(
        [("B", i, 10 + i) for i in range(9)], "build string, room int, capacity bigint")), 5)
    assert [(r.room, r.cap) for r in top.collect()] == [(0, 10), (0, 10), (1, 11), (1, 11), (2, 12)]


@pytest.mark.parametrize("distinct", [False, True])
def test_many_requests_are_answered_like_each(spark, distinct):
    rng = random.Random(5)
    course, meeting = [], []
    for term in ("200101", "200103", "200106"):
        for cid in range(8):
            course.append((term, cid, "ABC", str(cid)))
            meeting += [(term, cid, pos, "P", rng.choice([1, 2, 3, None]), rng.choice("AB")) for pos in range(rng.randint(1, 3))]
    book = Book(spark, course, meeting, [])
    capacity = spark.createDataFrame([(b, r, rng.choice([None, 5, 8, 8, 12, 30])) for b in "ABCD" for r in range(1, 6)], "build string, room int, capacity bigint")
    peaks = spark.createDataFrame([(b, r, t, rng.randint(1, 25)) for t in ("200101", "200103") for b in "AB" for r in (1, 2, 3)],
                                  "build string, room int, term string, peak bigint")
    requests = [(t, c, rng.choice([0, 0, 2, 9])) for t, c, *_ in course] + [("200101", 0, 1), ("200101", 0, 1), ("199901", 1, 0)]
    table = spark.createDataFrame(requests, "term string, cid int, extra int")
    got = {}
    for r in rooms.open_rooms_for(capacity, peaks, book.course, book.meeting, table, distinct=distinct).collect():
        got.setdefault((r.term, r.cid, r.extra), []).append((r["rank"], r.build, r.room, r.cap, r.filled))
    want = {}
    for term, cid, extra in set(requests):
        own = [(b, r) for t, c, _, _, r, b in meeting if (t, c) == (term, cid)]
        used = {(b, r) for t, _, _, _, r, b in meeting if t == term}
        free = sorted((r.capacity, r.build, r.room) for r in capacity.collect() if r.capacity is not None and (r.build, r.room) not in used)
        held = [r.peak for place in own for r in peaks.collect() if (r.build, r.room, r.term) == (*place, term) and free and r.peak + extra <= free[-1][0]]
        if held:
            copies = 1 if distinct else held.count(max(held))
            five = [x for x in free if x[0] >= max(held) + extra for _ in range(copies)][:5]
            want[term, cid, extra] = [(i, b, r, c, max(held)) for i, (c, b, r) in enumerate(five, 1)]
    assert {k: sorted(v) for k, v in got.items()} == want and want


def test_open_rooms_uses_fullest_room_that_fits_anywhere(spark):
    course = [("200101", 1, "ABC", "1")]
    meeting = [("200101", 1, 1, "P", 1, "A"), ("200101", 1, 2, "P", 2, "A")]
    book = Book(spark, course, meeting, [("200101", 1, 1, "M", 480, 530)])
    capacity = spark.createDataFrame([("B", 1, 20), ("B", 2, 11)], "build string, room int, capacity bigint")
    peaks = spark.createDataFrame([("A", 1, "200101", 30), ("A", 2, "200101", 10)],
                                  "build string, room int, term string, peak bigint")
    got = rooms.open_rooms(capacity, peaks, book.course, book.meeting, "200101", 1, 1)
    assert sorted(tuple(r) for r in got.collect()) == [("B", 1, 20, 10), ("B", 2, 11, 10)]
