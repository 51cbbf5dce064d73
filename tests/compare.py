"""Compare registered queries with their SQL; also runs alone: ``python tests/compare.py [sf] [names]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
ROOT = os.environ.get("TESTDATA", "/root/testdata")


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = sorted(tuple(repr(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], shown


def spark_rows(df):
    return _rows(df.columns, df.collect())


def sql_rows(con, sql):
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())


def difference(spark, con, query, folder) -> str | None:
    columns, rows = spark_rows(query.run(spark, folder))
    if query.sql is None:
        return None if rows else "no rows"
    want_columns, want = sql_rows(con, query.sql)
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    if rows != want:
        ours, theirs = sorted(set(rows) - set(want)), sorted(set(want) - set(rows))
        return f"{len(rows)} rows vs {len(want)}; ours {ours[:3]} theirs {theirs[:3]}"
    return None


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from registry import REGISTRY
    from reviewlens.session import build_session

    folder = f"{ROOT}/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    names = sys.argv[2:] or list(REGISTRY)
    spark = build_session(
        master="local[8]",
        extra={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    con, bad = duck(folder), 0
    for name in names:
        start = time.perf_counter()
        try:
            problem = difference(spark, con, REGISTRY[name], folder)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.perf_counter() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    spark.stop()


if __name__ == "__main__":
    main()
