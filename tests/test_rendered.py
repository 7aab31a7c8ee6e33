"""Report files written for the ingest queries, and the splits they are read back in."""

import pytest
from conftest import SF

from gradeweave.sources import rendered
from gradeweave.sources.derived import Derived
from gradeweave.sources.rendered import small_splits
from gradeweave.sources.reports import read_lines
from gradeweave.sources.shared import stage


@pytest.mark.parametrize("lines", [400, 4000])
def test_splits_do_not_grow_in_number_with_the_reports(spark, tmp_path, monkeypatch, lines):
    monkeypatch.setattr(rendered, "LEAST_SPLIT", 512)
    monkeypatch.setattr(rendered, "SPLITS", 16)
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text("".join(f"{i:06d},x\n" for i in range(lines)))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    with small_splits(spark, str(tmp_path)):
        found = read_lines(spark, str(tmp_path))
    assert spark.conf.get(key) == before
    assert found.count() == 2 * lines
    assert 8 <= found.select("file", "block").distinct().count() <= 18  # and not one for every 512 bytes


def test_rows_stored_by_a_column_are_whole(spark):
    rows = [(i, f"k{i % 11}" if i % 11 else None) for i in range(500)]  # more values than files are kept open
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    kept = stage(spark.createDataFrame(rows, "a long, k string").coalesce(1), "by-k", by="k")
    assert sorted(map(tuple, kept.collect())) == rows
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_enrolments_are_made_once_to_be_numbered(spark):
    plan = Derived(spark, SF).enroll._jdf.queryExecution().optimizedPlan().toString()
    assert "min(k" not in plan  # else once for the numbers and once for where ranges start
