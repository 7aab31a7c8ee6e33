"""Command line: set up the stored relations, write all fixed reports, search open rooms.

    python -m gradeweave setup REPORTS ROOT [--go-on]
    python -m gradeweave add REPORTS ROOT [--go-on]
    python -m gradeweave reports ROOT OUT [--print]
    python -m gradeweave open-rooms ROOT TERM CID EXTRA
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from gradeweave.operators.rooms import smallest_rooms
from gradeweave.plans.loading import add_reports
from gradeweave.plans.reports import RoomPlan, fixed_reports
from gradeweave.plans.setup import issue_counts, load_reports, table_quality
from gradeweave.sources.tables import Stored


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="gradeweave")
    commands = parser.add_subparsers(dest="command", required=True)
    setup = commands.add_parser("setup", help="read report files, store the relations and room capacities")
    setup.add_argument("reports")
    setup.add_argument("root")
    setup.add_argument("--go-on", action="store_true", help="leave out records whose quotes are never closed")
    add = commands.add_parser("add", help="read report files that no load has looked at, and merge the accepted ones into the relations")
    add.add_argument("reports")
    add.add_argument("root")
    add.add_argument("--go-on", action="store_true", help="leave out records whose quotes are never closed")
    reports = commands.add_parser("reports", help="write every fixed report, whole")
    reports.add_argument("root")
    reports.add_argument("out", help="folder: each report is a CSV folder in it")
    reports.add_argument("--print", action="store_true", help="print all their rows, too")
    rooms = commands.add_parser("open-rooms", help="the five smallest rooms a course could move to")
    rooms.add_argument("root")
    rooms.add_argument("term")
    rooms.add_argument("cid", type=int)
    rooms.add_argument("extra", type=int, help="students to add")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("gradeweave").getOrCreate()
    if args.command == "setup":
        stored = load_reports(spark, args.reports, args.root, args.go_on)
        _print("issues", issue_counts(stored))
        _print("violations", table_quality(stored).where("violations > 0"))
    elif args.command == "add":
        stored = add_reports(spark, args.reports, args.root, args.go_on)
        _print("rejected files", stored.manifest.where("not accepted").drop("bytes", "load", "accepted").orderBy("file"))
    elif args.command == "reports":
        for name, report in fixed_reports(Stored(spark, args.root)).items():
            path = f"{args.out}/{name}"
            report().write.mode("overwrite").option("header", True).csv(path)
            if args.print:
                _print(name, report())
    else:
        stored = Stored(spark, args.root)
        plan = RoomPlan(stored, stored.enroll)
        smallest_rooms(plan.open_rooms(args.term, args.cid, args.extra, capacity=stored.roomcap)).show()


def _print(name: str, df: DataFrame) -> None:
    """All rows, one partition at a time."""
    print(name)
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


if __name__ == "__main__":
    main()
