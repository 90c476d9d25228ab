"""Run registered queries against DuckDB: ``python -m tests.oracle [folder] [names...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        if path.exists():
            db.execute(f"create view {table} as select * from '{path}'")
    return db


def sort_key(row):
    return tuple((v is None, str(type(v)), v) for v in row)


def difference(got_columns, got, want_columns, want) -> str | None:
    """First difference of two results, ignoring row and column order."""
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    names = sorted(got_columns)
    left = [got_columns.index(n) for n in names]
    right = [want_columns.index(n) for n in names]
    a = sorted((tuple(r[i] for i in left) for r in got), key=sort_key)
    b = sorted((tuple(r[i] for i in right) for r in want), key=sort_key)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            return f"{dict(zip(names, x))} != {dict(zip(names, y))}"
    return None


def compare(spark, db, check, folder: str) -> str | None:
    df = check.run(spark, folder)
    got = [tuple(r) for r in df.collect()]
    if check.sql is None:
        return None if got else "no rows"
    relation = db.sql(check.sql)
    return difference(df.columns, got, list(relation.columns), relation.fetchall())


def main(arguments: list[str]) -> int:
    from lakeloom.checks import REGISTRY
    from lakeloom.session import build_session

    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(REGISTRY)
    spark = build_session("oracle", "local[8]", settings={
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, db, REGISTRY[name], folder)
        except Exception as failure:
            problem = f"{type(failure).__name__}: {" ".join(str(failure).split())[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} match")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
