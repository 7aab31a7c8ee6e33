"""Every report over the seven gradebook relations, as one DataFrame each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property
from typing import Protocol

from pyspark.sql import DataFrame

from gradeweave.operators import cohorts, gpa, loads, rooms
from gradeweave.sources.shared import stage


class Gradebook(Protocol):
    """Whatever has the relations: stored tables, freshly read reports, derived test relations."""

    course: DataFrame
    meeting: DataFrame
    daytime: DataFrame
    student: DataFrame
    enroll: DataFrame


@dataclass(frozen=True)
class RoomPlan:
    """Room reports share the conflict terms and the peaks built on them.

    Bookings and conflicts are staged: both are small next to enrolments and read by
    several steps.
    """

    book: Gradebook
    enroll: DataFrame

    @cached_property
    def booked(self) -> DataFrame:
        return stage(rooms.bookings(self.book.course, self.book.meeting, self.book.daytime), "bookings")

    @cached_property
    def conflicting(self) -> DataFrame:
        return stage(rooms.conflicting_bookings(self.booked), "conflicting")

    @cached_property
    def conflicts(self) -> DataFrame:
        return rooms.room_conflicts(self.booked, self.conflicting)

    @cached_property
    def excluded_terms(self) -> DataFrame:
        return rooms.conflict_terms(self.conflicting)

    @cached_property
    def peaks(self) -> DataFrame:
        return rooms.room_peaks(self.enroll, self.book.meeting, self.book.daytime, self.excluded_terms)

    @cached_property
    def capacity(self) -> DataFrame:
        return rooms.room_capacity(rooms.known_rooms(self.book.meeting), self.peaks)

    def open_rooms(self, term: str, cid: int, extra: int, distinct: bool = False,
                   capacity: DataFrame | None = None) -> DataFrame:
        """Rooms section ``cid`` could move to in ``term`` with ``extra`` more students.

        With a stored ``capacity`` only the term's own enrolments are read. Without one, the
        peaks of all terms are staged once (a row per room and term) and serve both sides.
        """
        book = self.book
        if capacity is None:
            peaks = stage(self.peaks, "peaks")
            capacity = stage(rooms.room_capacity(rooms.known_rooms(book.meeting), peaks), "capacity")
        else:
            peaks = rooms.room_peaks(self.enroll, book.meeting, book.daytime, self.excluded_terms, term)
        return rooms.open_rooms(capacity, peaks, book.course, book.meeting, term, cid, extra, distinct)


def fixed_reports(book: Gradebook) -> dict[str, Callable[[], DataFrame]]:
    """The fixed reports, by name, in the order they are usually read."""
    e, c, m = book.enroll, book.course, book.meeting
    return {
        "unit_load_share": lambda: loads.unit_load_share(e, c),
        "gpa_by_unit_load": lambda: loads.gpa_by_unit_load(e),
        "instructor_extremes": lambda: gpa.instructor_extremes(e, c, m),
        "course_passrate_extremes": lambda: gpa.course_passrate_extremes(e, c, m),
        "course_gpa_extremes": lambda: gpa.course_gpa_extremes(e, c, m),
        "room_conflicts": lambda: RoomPlan(book, e).conflicts.orderBy("crse1"),
        "major_extremes": lambda: gpa.major_extremes(e, c),
        "transfer_rate": lambda: cohorts.transfer_rate(e, book.student),
        "transfer_by_major": lambda: cohorts.transfer_by_major(e),
        "prereq_buckets": lambda: cohorts.prereq_buckets(cohorts.prereq_share(e, c)),
    }
