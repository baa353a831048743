"""Run registered queries on Spark and their SQL in DuckDB, and compare the rows.

Usage: ``python -m harness.compare [sf_dir] [query ...]``; ``COMPARE_ZONE`` sets the session
time zone, on which no result may depend.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from harness.oracles import ORACLES
from harness.spark_queries import QUERIES
from layerloom.session import build_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    return value.normalize() if isinstance(value, Decimal) else value


def _bag(rows, names: list[str]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> list[str]:
    """Differences between the two results; empty when they are equal."""
    df = QUERIES[name](spark, sf_dir)
    got = _bag(df.collect(), df.columns)
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    want = _bag(result.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    problems = [f"only in Spark: {r}" for r in list((got - want))[:3]]
    return problems + [f"only in SQL: {r}" for r in list((want - got))[:3]]


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    local = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if zone := os.environ.get("COMPARE_ZONE"):
        local["spark.sql.session.timeZone"] = zone
    local["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="compare-")
    spark = build_session("compare", "local[8]", **local)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        started = time.monotonic()
        try:
            problems = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':5}{name} {time.monotonic() - started:.1f}s", flush=True)
        for p in problems:
            print("     ", p, flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
