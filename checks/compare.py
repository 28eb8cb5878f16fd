"""Compare queries with their oracle SQL: python -m checks.compare [sf_dir] [query ...]."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES
from checks.views import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "<null>"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return repr(float(value))
    return str(value)


def normalised(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its oracle; None when nothing does."""
    df = QUERIES[name](spark, sf_dir)
    got = normalised(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(ORACLE[name])
    want = normalised([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} instead of {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows instead of {len(want[1])}"
    wrong = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or list(QUERIES):
        started = time.time()
        try:
            problem = difference(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:30s} {time.time() - started:6.2f}s {(problem or 'equal')[:900]}", flush=True)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
