"""Compare registered queries with their SQL: python tests/oracle_check.py <dir> [names...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

import __spark_entry__ as entry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    started = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"{len(got)} rows, no SQL, {took:.1f}s"
    started = time.time()
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    note = f"{len(got)} / {len(want)} rows, {took:.1f}s, sql {time.time() - started:.1f}s"
    if sorted(df.columns) != sorted(columns):
        return False, f"columns {sorted(df.columns)} / {sorted(columns)}"
    if got != want:
        extra, missing = sorted(set(got) - set(want), key=repr), sorted(set(want) - set(got), key=repr)
        return False, note + f"\n  columns {sorted(columns)}\n  only spark {extra[:3]}\n  only sql   {missing[:3]}"
    return True, note


if __name__ == "__main__":
    from shiftlake.session import local_session

    spark = local_session()
    con = connect(sys.argv[1])
    for name in sys.argv[2:] or entry.queries():
        try:
            ok, note = compare(spark, con, sys.argv[1], name)
        except Exception as e:
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name:26s} {note}", flush=True)
