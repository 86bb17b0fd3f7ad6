"""Compare registered queries with their SQL in DuckDB: ``python check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

from oreflow.registry import all_queries
from oreflow.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (decimal.Decimal, datetime.datetime, datetime.date)):
        return str(value)
    return value


def _rows(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, q, sf_dir: str) -> tuple[str, int]:
    df = q.run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if q.sql is None:
        return "rows-only", len(got)
    result = con.execute(q.sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} != {sorted(names)}", len(got)
    a, b = _rows(df.columns, got), _rows(names, want)
    if a != b:
        return f"DIFFERS rows {len(got)}/{len(want)} e.g. {list((a - b))[:2]} / {list((b - a))[:2]}", len(got)
    return "same", len(got)


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = build_session("oreflow-check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name, q in all_queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            verdict, n = compare(spark, con, q, sf_dir)
        except Exception as e:  # report and go on with the next query
            verdict, n = f"FAILED {type(e).__name__}: {str(e)[:600]}", -1
        bad += verdict not in ("same", "rows-only")
        print(f"{name:28s} {n:8d} rows {time.time() - start:6.1f}s  {verdict}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
