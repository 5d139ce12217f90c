"""Run checked queries in Spark and their SQL in DuckDB and compare the results.

``python -m tests.oracle [--sf DIR] [name ...]``
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(v)) for v in row)


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=_key)


SPARK_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def compare(spark, connection, name: str, run, sql: str, sf_dir: str) -> str | None:
    """None when both results are equal, else what differs."""
    df = run(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = rows_of(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    odd = {
        f.name: (f.dataType.simpleString(), types[f.name])
        for f in df.schema
        if SPARK_NAMES.get(f.dataType.simpleString()) != types[f.name] and types[f.name] != '"NULL"'
    }
    if odd:
        return f"types {odd}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            return f"{sorted(columns)}\n   {a}\n   {b}"
    return None if got or name.endswith("empty") else "both empty"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from __spark_entry__ import oracle_sql, queries
    from tests.session import local_session

    spark, connection = local_session(), connect(options.sf)
    sqls, bad = oracle_sql(), []
    for name, run in queries().items():
        if options.names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in options.names):
            continue
        started = time.time()
        try:
            problem = compare(spark, connection, name, run, sqls[name], options.sf) if name in sqls else (
                None if run(spark, options.sf).count() >= 0 else ""
            )
        except Exception as failure:  # noqa: BLE001 - reported and counted
            problem = f"{type(failure).__name__}: {str(failure)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - started:6.2f}s {name} {problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
