"""Run registered queries next to their SQL and compare the results.

    python -m checks.compare [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from adloom.session import build_session
from checks.oracle import ORACLE
from checks.queries import TABLES, registered


def normal(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(normal(row[i]) for i in order) for row in rows),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def compare(spark, connection, folder: str, name: str, query=None, sql=None) -> str | None:
    """None where the results agree, else what differs; ``query`` and ``sql`` if not those here."""
    frame = (query or registered()[name])(spark, folder)
    got_columns, got = frame.columns, [tuple(r) for r in frame.collect()]
    cursor = connection.execute(sql or ORACLE[name])
    want_columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} instead of {sorted(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    pairs = zip(rows_of(got_columns, got), rows_of(want_columns, want), strict=True)
    differing = [(g, w) for g, w in pairs if g != w]
    if differing:
        return f"{len(differing)} of {len(got)} rows differ, first {differing[0]}"
    return None


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session(
        "compare",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name in names or registered():
        started = time.perf_counter()
        try:
            problem = compare(spark, connection, folder, name) if name in ORACLE else "no SQL"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{time.perf_counter() - started:6.2f}s {name}: {problem or 'same'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    sys.exit(min(main(*sys.argv[1:]), 1))
