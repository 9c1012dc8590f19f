"""Run registered queries in Spark and DuckDB and compare rows.

``python -m tests.oracle [sf] [name part ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
ROOT = os.environ.get("TESTDATA", "/root/testdata")


def folder(sf: str) -> str:
    return f"{ROOT}/sf{sf}"


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, bool) or value is None or isinstance(value, (str, int, float)):
        return value
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    left = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    right = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} vs {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} vs {len(right[1])}"
    if not left[1]:
        return "no rows on both sides"
    bad = [(a, b) for a, b in zip(left[1], right[1]) if repr(a) != repr(b)]
    if bad:
        return f"{len(bad)} of {len(left[1])} rows differ, first: {dict(zip(left[0], zip(*bad[0])))}"
    return None


def session(cpus: int = 8):
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.master(f"local[{cpus}]").appName("opsledger-tests") \
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false") \
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC") \
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv):
    from opsledger.catalog import all_queries, all_sql
    sf = argv[0] if argv else "0.01"
    parts = argv[1:]
    spark, con = session(), duck(folder(sf))
    queries, sql = all_queries(), all_sql()
    failed = 0
    for name, fn in queries.items():
        if parts and not any(name.startswith(p) for p in parts):
            continue
        start = time.time()
        try:
            frame = fn(spark, folder(sf))
            if name in sql:
                problem = compare(frame, con, sql[name])
                state = "ok" if problem is None else f"DIFF {problem}"
            else:
                problem, state = None, f"rows only: {frame.count()}"
        except Exception as error:  # noqa: BLE001
            problem = state = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:40s} {time.time() - start:6.1f}s {state}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
