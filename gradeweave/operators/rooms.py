"""Rooms: double bookings, peak occupancy, derived capacity, rooms a course could move to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeweave.sources.shared import stage

SECTION = ["term", "cid"]
PLACE = ["term", "build", "room", "day"]
SLOT = ["st", "en"]


def bookings(course: DataFrame, meeting: DataFrame, daytime: DataFrame, term_suffix: str = "6") -> DataFrame:
    """Distinct (place, slot, course, instructor) of meetings with known times, in terms ending in ``term_suffix``."""
    wanted = F.col("term").endswith(term_suffix)
    held = meeting.where(wanted & F.col("build").isNotNull() & F.col("room").isNotNull())
    times = daytime.where(wanted & F.col("st").isNotNull() & F.col("en").isNotNull())
    return (
        held.select(*SECTION, "pos", "build", "room", "full_name")
        .join(times.select(*SECTION, "pos", "day", *SLOT), [*SECTION, "pos"])
        .join(course.where(wanted).select(*SECTION, "subj", "crse"), SECTION)
        .select(*PLACE, *SLOT, "subj", "crse", "full_name")
        .distinct()
    )


def conflicting_bookings(booked: DataFrame) -> DataFrame:
    """Bookings that overlap, in the same place, a higher-numbered course held by another instructor.

    Bookings are never paired with each other. The starts and ends of a place cut its day into
    parts, a slot covers whole parts, and slots that start before they end overlap exactly
    when they share one. Per place and part two rivals are enough: the highest course numbers
    under distinct instructors. Whichever instructor a booking has, one of the two tells
    whether it has a partner. So every booking looks up its parts in a table with one row per
    place and part: a few rows per booking, as a place has few different slots.

    Instructors of one course in one slot are kept as first and last name, which is enough
    to know if there is another one. ``booked`` is read several times: pass a stored table.
    """
    units = _units(booked)
    forward = F.col("st") < F.col("en")
    parts = _parts(units.where(forward))
    first, second = F.col("rank") == 1, F.col("rank") == 2
    covering = (
        _two_rivals(booked.where(forward).join(parts, [*PLACE, *SLOT]).select(*PLACE, "full_name", "crse", "part"), [*PLACE, "part"])
        .groupBy(*PLACE, "part").agg(
            F.max(F.when(first, F.col("crse"))).alias("crse_1"),
            F.max(F.when(first, F.col("full_name"))).alias("name_1"),
            F.max(F.when(second, F.col("crse"))).alias("crse_2"),
        )
    )
    several = F.col("first_name") != F.col("last_name")
    rival = F.when(several | (F.col("name_1") != F.col("first_name")), F.col("crse_1")).otherwise(F.col("crse_2"))
    found = (
        units.where(forward).join(parts, [*PLACE, *SLOT]).join(covering, [*PLACE, "part"])
        .where(rival > F.col("crse")).select(units.columns)
    )
    if not booked.where(~forward).isEmpty():
        found = found.unionByName(_backward_conflicts(booked, units))
    return found.distinct()


def conflict_terms(conflicting: DataFrame) -> DataFrame:
    """Terms shown by ``room_conflicts``: the first term of each slot that has a conflict."""
    return conflicting.groupBy(*SLOT).agg(F.min("term").alias("term")).select("term").distinct()


def room_conflicts(booked: DataFrame, conflicting: DataFrame) -> DataFrame:
    """One pair of conflicting courses per (start, end) over all terms: the first by term, then by course."""
    first = conflicting.groupBy(*SLOT).agg(F.min(F.struct("term", "subj", "crse")).alias("first"))
    first = first.select(*SLOT, "first.*")
    mine = conflicting.join(first, [*SLOT, "term", "subj", "crse"]).select(
        *PLACE,
        F.col("st").alias("st1"), F.col("en").alias("en1"), F.col("subj").alias("subj1"), F.col("crse").alias("crse1"),
        F.col("first_name").alias("a1"), F.col("last_name").alias("b1"),
    )
    same_single = (F.col("a1") == F.col("b1")) & (F.col("first_name") == F.col("a1")) & (F.col("last_name") == F.col("a1"))
    return (
        mine.join(_units(booked), PLACE)
        .where((F.col("crse") > F.col("crse1")) & (F.col("st") < F.col("en1")) & (F.col("en") > F.col("st1")) & ~same_single)
        .groupBy(F.col("st1").alias("st"), F.col("en1").alias("en"), "term", "subj1", "crse1")
        .agg(F.min(F.struct("subj", "crse")).alias("second"))
        .select("subj1", "crse1", F.col("second.subj").alias("subj2"), F.col("second.crse").alias("crse2"), "term", *SLOT)
    )


def conflict_links(booked: DataFrame) -> DataFrame:
    """Pairs of conflicting bookings as counts: per place and pair of slots how many there are, and the first one.

    A pair is a booking in the first slot (st1, en1) and one of a higher course number under another
    instructor in the second (st2, en2), which overlaps the first or is the same. Bookings are not
    paired. Of all pairs in the order of course numbers those under one instructor are taken away,
    and both are sums over running counts by course number, which meet once per pair of slots. The
    first pair is the first booking that has a partner, told by the two rivals of the other slot,
    with the first of its partners. ``booked`` is read several times: pass a stored table.
    """
    one, two = ["st1", "en1"], ["st2", "en2"]
    slots = booked.select(*PLACE, *SLOT).distinct()
    pairs = stage(
        slots.select(*PLACE, F.col("st").alias("st1"), F.col("en").alias("en1"))
        .join(slots.select(*PLACE, F.col("st").alias("st2"), F.col("en").alias("en2")), PLACE)
        .where((F.col("st1") < F.col("en2")) & (F.col("en1") > F.col("st2"))), "slot-pairs")
    key = [*PLACE, *one, *two]

    def side(counts: DataFrame, names: list[str]) -> DataFrame:
        return pairs.join(counts.withColumnsRenamed(dict(zip(SLOT, names))), [*PLACE, *names])

    def ordered(by: list[str]) -> DataFrame:
        """Pairs of bookings in the order of their course numbers, by ``by`` as well."""
        counts = booked.groupBy(*PLACE, *SLOT, *by, "crse").agg(F.count("*").alias("n"))
        both = side(counts, one).select(*key, *by, "crse", F.col("n").alias("n1"), F.lit(0).cast("bigint").alias("n2")).unionByName(
            side(counts, two).select(*key, *by, "crse", F.lit(0).cast("bigint").alias("n1"), F.col("n").alias("n2")))
        steps = both.groupBy(*key, *by, "crse").agg(F.sum("n1").alias("n1"), F.sum("n2").alias("n2"))
        lower = F.sum("n1").over(Window.partitionBy(*key, *by).orderBy("crse").rowsBetween(Window.unboundedPreceding, -1))
        return steps.withColumn("links", F.col("n2") * F.coalesce(lower, F.lit(0))).groupBy(*key).agg(F.sum("links").alias("links"))

    links = ordered([]).join(ordered(["full_name"]).withColumnRenamed("links", "own"), key).select(*key, (F.col("links") - F.col("own")).alias("links"))
    links = stage(links.where(F.col("links") > 0), "links")
    first, second = F.col("rank") == 1, F.col("rank") == 2
    rivals = _two_rivals(booked, [*PLACE, *SLOT]).groupBy(*PLACE, *SLOT).agg(
        F.max(F.when(first, F.col("crse"))).alias("crse_1"), F.max(F.when(first, F.col("full_name"))).alias("name_1"),
        F.max(F.when(second, F.col("crse"))).alias("crse_2")).withColumnsRenamed(dict(zip(SLOT, two)))
    rival = F.when(F.col("name_1") != F.col("full_name"), F.col("crse_1")).otherwise(F.col("crse_2"))
    begins = (
        links.join(booked.withColumnsRenamed(dict(zip(SLOT, one))), [*PLACE, *one]).join(rivals, [*PLACE, *two])
        .where(rival > F.col("crse")).groupBy(*key).agg(F.min(F.struct("subj", "crse")).alias("a"))
    )
    # all who hold the first booking's course in its slot: two names are enough to know who else there is
    holders = _units(booked).withColumnsRenamed(dict(zip(SLOT, one))).withColumn("a", F.struct("subj", "crse")).drop("subj", "crse")
    partner = booked.withColumnsRenamed(dict(zip(SLOT, two)))
    ends = (
        begins.join(holders, [*PLACE, *one, "a"]).join(partner, [*PLACE, *two])
        .where((F.col("crse") > F.col("a.crse")) & ((F.col("full_name") != F.col("first_name")) | (F.col("full_name") != F.col("last_name"))))
        .groupBy(*key, "a").agg(F.min(F.struct("subj", "crse")).alias("b"))
    )
    return links.join(ends, key).select(
        *key, "links", F.col("a.subj").alias("subj1"), F.col("a.crse").alias("crse1"), F.col("b.subj").alias("subj2"), F.col("b.crse").alias("crse2"))


def room_peaks(
    enroll: DataFrame, meeting: DataFrame, daytime: DataFrame, excluded_terms: DataFrame, term: str | None = None
) -> DataFrame:
    """Most seats seen in a room at once, per term: over sections sharing a day and slot, and over single meetings.

    Enrolments become one row per section before any join. A meeting without days yields
    one row with a NULL day, which counts on its own and never with others.
    """
    if term is not None:
        enroll, meeting, daytime = (t.where(F.col("term") == term) for t in (enroll, meeting, daytime))
    seats = enroll.groupBy(*SECTION).agg(F.count("seat").alias("seats")).join(excluded_terms, "term", "left_anti")
    return (
        seats.join(meeting.select(*SECTION, "pos", "build", "room"), SECTION)
        .join(daytime.select(*SECTION, "pos", "day", *SLOT), [*SECTION, "pos"], "left")
        .groupBy("build", "room", "term", "day", *SLOT)
        .agg(F.sum("seats").alias("together"), F.max("seats").alias("alone"))
        .select("build", "room", "term",
                F.when(F.col("day").isNull(), F.col("alone")).otherwise(F.col("together")).alias("seats"))
        .groupBy("build", "room", "term").agg(F.max("seats").alias("peak"))
    )


def known_rooms(meeting: DataFrame) -> DataFrame:
    return meeting.where((F.col("build") != "") & F.col("room").isNotNull()).select("build", "room").distinct()


def room_capacity(rooms: DataFrame, peaks: DataFrame) -> DataFrame:
    """Highest peak per known room; NULL for rooms only seen in excluded terms."""
    highest = peaks.groupBy("build", "room").agg(F.max("peak").alias("capacity"))
    return rooms.join(highest, ["build", "room"], "left").select("build", "room", "capacity")


def open_rooms(
    capacity: DataFrame,
    term_peaks: DataFrame,
    course: DataFrame,
    meeting: DataFrame,
    term: str,
    cid: int,
    extra: int,
    distinct: bool = False,
) -> DataFrame:
    """Rooms unused all ``term`` that could take the course's current room plus ``extra`` students.

    ``term_peaks`` are the room peaks of that term. Of the course's rooms only the fullest
    one that any free room can still take counts; since that depends only on the largest
    free room, it is a scalar and no room-by-room comparison is made. Each free room is
    repeated once per meeting of the course in such rooms, unless ``distinct``.
    """
    in_term = meeting.where(F.col("term") == term)
    used = in_term.join(course.where(F.col("term") == term).select(*SECTION), SECTION, "left_semi")
    free = capacity.where(F.col("capacity").isNotNull()).join(
        used.select("build", "room").distinct(), ["build", "room"], "left_anti")
    largest = free.agg(F.max("capacity")).scalar()
    current = (
        used.where(F.col("cid") == cid).groupBy("build", "room").agg(F.count("*").alias("meetings"))
        .join(term_peaks.where(F.col("term") == term), ["build", "room"])
        .where(F.col("peak") + extra <= largest)
        .groupBy(F.col("peak").alias("filled")).agg(F.sum("meetings").alias("meetings"))
    )
    fullest = current.agg(F.max(F.struct("filled", "meetings")).alias("f"))
    filled = fullest.select("f.filled").scalar()
    repeats = F.lit(1) if distinct else fullest.select(F.col("f.meetings").cast("int")).scalar()
    fitting = free.where(F.col("capacity") >= filled + extra)
    return fitting.select(
        "build", "room", F.col("capacity").alias("cap"), filled.alias("filled"),
        F.explode(F.array_repeat(F.lit(0), repeats)).alias("copy"),
    ).drop("copy")


def smallest_rooms(rooms: DataFrame, top: int = 5) -> DataFrame:
    return rooms.orderBy("cap", "build", "room").limit(top)


def open_rooms_for(
    capacity: DataFrame, peaks: DataFrame, course: DataFrame, meeting: DataFrame, requests: DataFrame, top: int = 5, distinct: bool = False
) -> DataFrame:
    """The ``top`` smallest rooms for each of many requests (term, cid, extra): what ``open_rooms`` and ``smallest_rooms`` say of each.

    The free rooms of a requested term stand in one order, by capacity. A request needs all from the
    first that is large enough, whose place is the number of smaller ones: found for each different
    size asked for in a term, in one pass over both in order. Places are then equal keys, ``top`` of
    them per request, so nothing is compared room by room. A room is repeated once per meeting of the
    course in its fullest room, unless ``distinct``.
    """
    asked = stage(requests.select(*SECTION, "extra").distinct(), "requests")
    terms = asked.select("term").distinct()
    in_term = meeting.join(terms, "term", "left_semi")
    used = stage(in_term.join(course.select(*SECTION), SECTION, "left_semi").select(*SECTION, "build", "room"), "used")
    all_terms = terms.agg(F.collect_set("term")).scalar()  # as many as terms are asked for
    free = capacity.where(F.col("capacity").isNotNull()).select("build", "room", "capacity", F.explode(all_terms).alias("term"))
    free = free.join(used.select("term", "build", "room").distinct(), ["term", "build", "room"], "left_anti")
    place = F.row_number().over(Window.partitionBy("term").orderBy("capacity", "build", "room"))
    free = stage(free.withColumn("place", place), "free-rooms")
    largest = free.groupBy("term").agg(F.max("capacity").alias("largest"))
    current = (
        asked.join(used, SECTION).groupBy(*SECTION, "extra", "build", "room").agg(F.count("*").alias("meetings"))
        .join(peaks, ["term", "build", "room"]).join(largest, "term").where(F.col("peak") + F.col("extra") <= F.col("largest"))
        .groupBy(*SECTION, "extra", F.col("peak").alias("filled")).agg(F.sum("meetings").alias("meetings"))
        .groupBy(*SECTION, "extra").agg(F.max(F.struct("filled", "meetings")).alias("f"))
        .select(*SECTION, "extra", "f.filled", F.lit(1).alias("copies") if distinct else F.col("f.meetings").alias("copies"))
        .withColumn("size", F.col("filled") + F.col("extra"))
    )
    current = stage(current, "asked-sizes")
    sizes = current.select("term", F.col("size").alias("capacity")).distinct().withColumn("rooms", F.lit(0))
    line = free.groupBy("term", "capacity").agg(F.count("*").cast("int").alias("rooms")).unionByName(sizes)
    line = line.groupBy("term", "capacity").agg(F.sum("rooms").alias("rooms"))
    smaller = F.sum("rooms").over(Window.partitionBy("term").orderBy("capacity").rowsBetween(Window.unboundedPreceding, -1))
    starts = line.select("term", F.col("capacity").alias("size"), F.coalesce(smaller, F.lit(0)).alias("smaller"))
    wanted = current.join(starts, ["term", "size"]).withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(top - 1))))
    wanted = wanted.withColumn("place", (F.col("smaller") + 1 + F.floor(F.col("number") / F.col("copies"))).cast("int"))
    return wanted.join(free, ["term", "place"]).select(*SECTION, "extra", (F.col("number") + 1).alias("rank"), "build", "room", F.col("capacity").alias("cap"), "filled")


def _parts(slots: DataFrame) -> DataFrame:
    """Per place and slot, the parts of the day it covers: those that begin at a start or end of some slot there.

    A place has at most 86,400 such bounds a day, so their list fits a row.
    """
    slots = slots.select(*PLACE, *SLOT).distinct()
    bounds = slots.groupBy(*PLACE).agg(F.array_union(F.collect_set("st"), F.collect_set("en")).alias("bounds"))
    covered = F.filter("bounds", lambda b: (b >= F.col("st")) & (b < F.col("en")))
    return slots.join(bounds, PLACE).select(*PLACE, *SLOT, F.explode(covered).alias("part"))


def _units(booked: DataFrame) -> DataFrame:
    return booked.groupBy(*PLACE, *SLOT, "subj", "crse").agg(
        F.min("full_name").alias("first_name"), F.max("full_name").alias("last_name"))


def _backward_conflicts(booked: DataFrame, units: DataFrame) -> DataFrame:
    """Conflicts in which one slot ends before it starts, as entered: such slots cover no part of the day.

    The overlap is then taken by its two inequalities, between bookings and the two rivals
    of each slot on the other side.
    """
    forward = F.col("st") < F.col("en")
    rivals = _two_rivals(booked, [*PLACE, *SLOT]).select(
        *PLACE, F.col("st").alias("st2"), F.col("en").alias("en2"),
        F.col("full_name").alias("name2"), F.col("crse").alias("crse2"))
    other_forward = F.col("st2") < F.col("en2")
    meets: Column = (F.col("st2") < F.col("en")) & (F.col("en2") > F.col("st"))
    other_name = (F.col("first_name") != F.col("name2")) | (F.col("last_name") != F.col("name2"))
    sides = [(~forward, other_forward), (forward, ~other_forward)]
    pairs = [units.where(mine).join(rivals.where(theirs), PLACE) for mine, theirs in sides]
    return pairs[0].unionByName(pairs[1]).where(
        meets & other_name & (F.col("crse2") > F.col("crse"))).select(units.columns)


def _two_rivals(df: DataFrame, keys: list[str]) -> DataFrame:
    """The two instructors with the highest course numbers per ``keys``, ranked.

    Partial maxima and Spark's early top-k keep a crowded group to two rows per task before
    it is shuffled as one group.
    """
    order = Window.partitionBy(*keys).orderBy(F.col("crse").desc(), "full_name")
    return (
        df.groupBy(*keys, "full_name").agg(F.max("crse").alias("crse"))
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= 2)
    )
