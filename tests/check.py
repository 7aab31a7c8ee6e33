"""Run registered queries against their oracle SQL: ``python tests/check.py SF_DIR [name ...]``."""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as contract  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("gradeweave")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def table(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def same(a, b) -> bool:
    return type(a) is type(b) and a == b


def difference(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    df = contract.queries()[name](spark, sf_dir)
    mine = table(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    theirs = table(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    for x, y in zip(mine, theirs):
        if not all(map(same, x, y)):
            return f"{x} != {y}"
    return None if mine else "no rows"


if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = session(), oracle(sf_dir)
    for name in names or contract.oracle_sql():
        start = time.time()
        try:
            found = difference(spark, con, sf_dir, name)
        except Exception as e:  # report and go on with the next query
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{name:32s} {time.time() - start:6.1f}s {'ok' if found is None else found}", flush=True)
