"""Run queries in Spark and the comparison SQL in DuckDB, side by side.

python -m workload.compare SF_DIR [query …]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

from corpusgraph.session import build_session
from workload.check import TABLES, rows_of
from workload.registry import CHECKS


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return connection


def local_session():
    return build_session(
        master=f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )


_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


def other_types(frame, description) -> list[str]:
    """Columns whose types differ, such as a sum that became a wider integer."""
    theirs = {d[0]: str(d[1]) for d in description}
    return [
        f"{name}: {kind} and {theirs[name]}"
        for name, kind in frame.dtypes
        if kind in _KINDS and theirs[name] != _KINDS[kind]
    ]


def difference(spark, connection, sf: str, name: str) -> str | None:
    """What differs between the two results, None when nothing does."""
    check = CHECKS[name]
    frame = check.job(spark, sf)
    got = rows_of(frame.columns, frame.collect())
    if check.sql is None:
        return None if got else "no rows"
    result = connection.execute(check.sql)
    columns = [d[0] for d in result.description]
    expected = rows_of(columns, result.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} and {sorted(columns)}"
    if other := other_types(frame, result.description):
        return f"types: {other}"
    if got != expected:
        extra = [r for r in got if r not in set(expected)][:2]
        missing = [r for r in expected if r not in set(got)][:2]
        return f"{len(got)} and {len(expected)} rows; {extra} and {missing}"
    return None if got else "no rows"


def main(sf: str, names: list[str]) -> int:
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf)
    wrong = 0
    for name in names or CHECKS:
        start = time.monotonic()
        try:
            found = difference(spark, connection, sf, name)
        except Exception as problem:
            found = f"{type(problem).__name__}: {str(problem)[:600]}"
        wrong += found is not None
        took = time.monotonic() - start
        verdict = "ok  " if found is None else "DIFF"
        print(f"{verdict} {took:6.2f}s {name} {(found or str())[:1500]}", flush=True)
    return wrong


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
