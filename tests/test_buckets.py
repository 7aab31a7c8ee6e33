"""Reports by student on bucketed enrolments: same results, and enrolments are not shuffled."""

import re

from test_setup import report

from gradeweave.operators import cohorts, loads
from gradeweave.plans.setup import load_reports
from gradeweave.sources.buckets import bucket_enrolments, open_buckets


def shuffled_scans(plan):
    """For each scan of bucketed student ids, whether an exchange stands between it and the aggregate by student."""
    above = []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [(d, text) for d, text in above if d < depth] + [(depth, line)]
        if re.search(r"Scan parquet \S*enroll_buckets\[sid", line):
            last = max(i for i, (_, text) in enumerate(above) if re.search(r"Aggregate\(keys=\[[^]]*sid", text) and "partial_" not in text)
            yield any(re.search(r"(?<!Broadcast)Exchange", text) for _, text in above[last:])


def test_no_exchange_over_enrolments(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i, term in enumerate(["200101", "200103", "200106"]):
        (tmp_path / "in" / f"{i}.csv").write_text(report(term, [(1, 3 + i), (2, 6)]).replace("ABC,102", "ABC,203").replace("ABC1", f"{'XA'[i // 2]}BC1"))
    stored = load_reports(spark, str(tmp_path / "in"), str(tmp_path / "tables"))
    spark.sql("DROP TABLE IF EXISTS enroll_buckets")
    held = bucket_enrolments(stored, "enroll_buckets", 4)
    reports = {
        "unit_load_share": lambda e: loads.unit_load_share(e, stored.course), "gpa_by_unit_load": loads.gpa_by_unit_load,
        "transfer_by_major": cohorts.transfer_by_major, "prereq_share": lambda e: cohorts.prereq_share(e, stored.course),
    }
    options = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "1g"}  # sizes of courses are only estimated here
    before = {k: spark.conf.get(k) for k in options}
    try:
        for name, run in reports.items():
            want = sorted(map(tuple, run(stored.enroll).collect()), key=str)
            got = sorted(map(tuple, run(held).collect()), key=str)
            assert got == want and want, (name, got, want)
            if name == "prereq_share":
                continue  # so few enrolments would themselves be broadcast to the courses
            for k, v in options.items():
                spark.conf.set(k, v)
            shuffled = list(shuffled_scans(run(held)._jdf.queryExecution().executedPlan().toString()))
            assert shuffled and not any(shuffled), name
            for k, v in before.items():
                spark.conf.set(k, v)
        spark.sql("DROP TABLE enroll_buckets")
        again = open_buckets(spark, "enroll_buckets", f"{tmp_path}/tables/enroll_by_student", 4)
        assert again.count() == stored.enroll.count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sql("DROP TABLE IF EXISTS enroll_buckets")
