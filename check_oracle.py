"""Runs every registered query and its DuckDB counterpart on one data set and compares the rows.

Usage: python check_oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from waitflow.oracle import ORACLES
from waitflow.queries import QUERIES
from waitflow.session import local

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def _plain(v: object) -> object:
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return datetime.datetime(v.year, v.month, v.day).isoformat()
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _sorted(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(directory).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, directory: str, name: str) -> str:
    """Empty when equal, otherwise what differs."""
    df = QUERIES[name](spark, directory)
    got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(ORACLES[name])
    want = _sorted([c[0] for c in found.description], found.fetchall())
    spark_types = {c: TYPES.get(t, t) for c, t in df.dtypes}
    duck_types = {r[0]: r[1] for r in con.execute("DESCRIBE " + ORACLES[name]).fetchall()}
    if spark_types != duck_types:
        return f"types {sorted(set(spark_types.items()) ^ set(duck_types.items()))}"
    if got[0] != want[0]:
        return f"columns {sorted(set(got[0]) ^ set(want[0]))}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            bad = [(c, x, y) for c, x, y in zip(got[0], a, b) if x != y]
            n = sum(1 for x, y in zip(got[1], want[1]) if x != y)
            return f"{n} of {len(want[1])} rows differ, first {bad[:4]}"
    return ""


def main() -> int:
    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local()
    spark.sparkContext.setLogLevel("OFF")
    con = connect(directory)
    failed = 0
    for name in names:
        if name not in ORACLES:
            print(f"{name:36s} no SQL")
            continue
        start = time.time()
        try:
            problem = compare(spark, con, directory, name)
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        failed += bool(problem)
        print(f"{name:36s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    print(f"{failed} failed of {len(names)}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
