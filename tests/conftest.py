import os
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]
import check  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    return check.session()


@pytest.fixture(scope="session")
def oracle():
    return check.oracle(SF)


@pytest.fixture
def tiny_splits(spark):
    """Files read in splits of a few lines, so that everything carried between blocks is used."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "61b")
    yield
    spark.conf.set(key, before)
