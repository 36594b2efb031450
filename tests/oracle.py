"""Run a query on Spark and its SQL twin on DuckDB and compare the rows.

As a program: ``python -m tests.oracle [--sf DIR] [NAME ...]`` prints one line per query.
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null" if value is None else "nan"
    if isinstance(value, bool):
        return f"b:{value}"
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, int):
        return f"i:{value}"
    if isinstance(value, float):
        return f"f:{value:.9g}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return f"{type(value).__name__}:{value}"


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(record[i]) for i in order) for record in records)


def compare(df, con, sql):
    """None when equal, else a description of the difference."""
    cursor = con.execute(sql)
    theirs_columns = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    ours = [tuple(row) for row in df.collect()]
    if sorted(df.columns) != sorted(theirs_columns):
        return f"columns {sorted(df.columns)} against {sorted(theirs_columns)}"
    a, b = rows_of(df.columns, ours), rows_of(theirs_columns, theirs)
    if a == b:
        return None
    only_a, only_b = set(a) - set(b), set(b) - set(a)
    return f"{len(a)} against {len(b)} rows; ours only {sorted(only_a)[:3]}; theirs only {sorted(only_b)[:3]}"


def main():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tests.conftest import make_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con, oracle = make_session(), connect(args.sf), entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if args.names and name not in args.names:
            continue
        began = time.time()
        try:
            df = run(spark, args.sf)
            verdict = compare(df, con, oracle[name]) if name in oracle else f"no SQL, {df.count()} rows"
        except Exception as error:  # report and go on
            verdict = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        bad += verdict is not None and name in oracle
        print(f"{'ok ' if verdict is None else 'BAD'} {name:36} {time.time() - began:6.2f}s {verdict or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
