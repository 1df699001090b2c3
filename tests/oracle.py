"""Compare every registered query with its SQL in DuckDB.

Run as a script for all queries or the named ones:
    python tests/oracle.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = os.environ.get("TOKENLOOM_TESTDATA", "/root/testdata")


TIMES: dict[str, float] = {}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        if file.endswith(".parquet"):
            con.execute(
                f"CREATE VIEW {file[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{file}')"
            )
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if value is not None and value.__class__.__name__ in ("datetime", "Timestamp"):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, name: str, sf_dir: str) -> str | None:
    """None when equal, else a description of the difference."""
    from __spark_entry__ import oracle_sql, queries

    began = time.time()
    df = queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    TIMES[name] = time.time() - began
    sql = oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    con = connect(sf_dir)
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    want = rows_of(columns, result.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{str(a)[:300]} vs {str(b)[:300]}"
    return None


def main() -> int:
    from tokenloom.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from __spark_entry__ import queries

    spark = build_session(
        "oracle",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in args.names or queries():
        began = time.time()
        try:
            difference = compare(spark, name, f"{TESTDATA}/sf{args.sf}")
        except Exception as error:  # noqa: BLE001
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += difference is not None
        both, ours = time.time() - began, TIMES.get(name, 0.0)
        print(f"{name:28s} {ours:6.2f}s + {both - ours:6.2f}s  {difference or 'ok'}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
