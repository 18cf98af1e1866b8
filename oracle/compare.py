"""Run registered queries and their SQL side by side: ``python -m oracle.compare [folder] [name ...]``."""

from __future__ import annotations

import sys
import time
from decimal import Decimal

import duckdb

from oracle.sql import SQL
from pennyflow.catalog import QUERIES
from pennyflow.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, (float, Decimal)):
        return round(float(value), 5)
    if isinstance(value, bool):
        return str(value)
    return float(value) if isinstance(value, int) else value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, con, name: str, folder: str) -> str | None:
    df = QUERIES[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(SQL[name])
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if got != want:
        extra = [r for r in got if r not in want][:3]
        missing = [r for r in want if r not in got][:3]
        return f"{len(got)} / {len(want)} rows; only Spark {extra}; only SQL {missing}"
    print(f"ok {name} {len(got)} rows", end="")
    return None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    con.execute("SET timezone = 'UTC'")
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, name, folder) if name in SQL else "no SQL"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        if problem:
            bad += problem != "no SQL"
            print(f"-- {name}: {problem}", end="")
        print(f" ({time.time() - start:.1f}s)", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
