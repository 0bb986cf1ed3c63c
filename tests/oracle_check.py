"""Runs every registered query against its DuckDB SQL and reports differences."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    return con


def normal(value: object) -> str:
    if isinstance(value, float):
        return repr(round(value, 9))
    return repr(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, folder: str) -> str:
    query, sql = entry.queries()[name], entry.oracle_sql().get(name)
    begun = time.time()
    df = query(spark, folder)
    got = [tuple(r) for r in df.collect()]
    spent = time.time() - begun
    if sql is None:
        return f"rows-only rows={len(got)} {spent:.2f}s"
    begun = time.time()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    oracle = time.time() - begun
    if sorted(df.columns) != sorted(names):
        return f"FAIL columns {sorted(df.columns)} != {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        diff = [x for x in a if x not in set(b)][:2], [x for x in b if x not in set(a)][:2]
        return f"FAIL rows {len(a)} vs {len(b)}\n   spark only {diff[0]}\n   duckdb only {diff[1]}"
    return f"ok rows={len(a)} spark={spent:.2f}s duckdb={oracle:.2f}s"


def main(folder: str, wanted: list[str]) -> None:
    from veilstone.session import build_session

    spark = build_session(
        spark__master="local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in entry.queries():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            print(f"{name}: {compare(spark, con, name, folder)}", flush=True)
        except Exception as problem:
            print(f"{name}: ERROR {str(problem)[:400]}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
