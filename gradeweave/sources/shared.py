"""Shared storage for results that cut a lineage and must outlive an executor."""

from __future__ import annotations

import tempfile
import warnings
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

WRITERS, _WRITERS = 8, "spark.sql.maxConcurrentOutputFileWriters"


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``; a fresh local one only where Spark itself is local."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="gradeweave-"))
        folder = context.getCheckpointDir()
    if folder.startswith("file:") and not context.master.startswith("local"):
        warnings.warn(f"{folder} must be a mount that all executors share", stacklevel=2)
    return folder


def stage(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to shared storage once and read it back, so that later uses do not recompute it.

    ``by``: a column of few values; later reads of one value pass over all other rows. A task keeps
    ``WRITERS`` files of different values open and only sorts its rows by value if there are more.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/gradeweave/{label}-{uuid4().hex}"
    if not by:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, str(WRITERS))
    try:
        df.write.partitionBy(by).parquet(path)
    finally:
        spark.conf.set(_WRITERS, before)
    return spark.read.schema(df.schema).parquet(path)
