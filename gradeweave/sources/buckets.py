"""A second layout of enrolments, for reports by student: buckets by student id, in the catalog.

Stored relations are partitioned by term, which prunes terms and keeps any key spread over many
files. Reports over whole histories group by student instead. On this layout they find each student's
rows in one bucket and read enrolments without shuffling them: unit loads, GPA by unit load, transfers
and prerequisites.

A student id that holds a large share of all rows would be one bucket, and one task. Where there may
be such ids, keep to the layout by term, whose partial sums make a crowded id a few rows per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeweave.sources.schemas import SCHEMAS
from gradeweave.sources.tables import Stored


def open_buckets(spark: SparkSession, table: str, path: str, buckets: int) -> DataFrame:
    """Enrolments as bucketed below ``path``, under the name ``table``, which is entered in the catalog if it is not there."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({SCHEMAS['enroll']}) USING parquet "
              f"CLUSTERED BY (sid) SORTED BY (sid) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def bucket_enrolments(stored: Stored, table: str, buckets: int) -> DataFrame:
    """Write the enrolments of ``stored`` in buckets, beside them, and give them back as that table.

    One task writes a bucket, so there is one file in each, and sorted order is kept on reading.
    """
    found = open_buckets(stored.spark, table, f"{stored.root}/enroll_by_student", buckets)
    rows = stored.enroll.select(*[F.col(c) for c in found.columns])
    rows.repartition(buckets, "sid").write.mode("overwrite").insertInto(table)
    return stored.spark.table(table)
