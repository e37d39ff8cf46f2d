"""Run every query on Spark and DuckDB and compare the rows.

``python -m checks.compare [sf_dir] [query ...]``
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks import oracle, queries


def local_session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("checks")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _rows(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def differences(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """None if both agree, else what differs."""
    df = queries.registered()[name](spark, sf_dir)
    got = _rows(df.columns, df.collect())
    result = con.execute(oracle.statements()[name])
    columns = [d[0] for d in result.description]
    want = _rows(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        extra, missing = list((got - want))[:3], list((want - got))[:3]
        return f"{sum(got.values())} vs {sum(want.values())} rows\n  spark {extra}\n  sql   {missing}"
    return None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(queries.registered())
    spark, con, bad = local_session(), connect(sf_dir), 0
    for name in names:
        start = time.perf_counter()
        try:
            problem = differences(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{time.perf_counter() - start:6.2f}s {name}: {problem or 'ok'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    spark.stop()


if __name__ == "__main__":
    main()
