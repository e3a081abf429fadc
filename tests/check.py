"""Runs registered queries against their SQL in DuckDB: python tests/check.py <folder> [names]."""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import __spark_entry__ as entry  # noqa: E402
from haulwatch.sources.derived import TABLES  # noqa: E402


def normal(value):
    if value is None:
        return ""
    if isinstance(value, float):
        return "" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name):
    """None when equal, else a short text."""
    df = entry.queries()[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(entry.oracle_sql()[name])
    if sorted(rel.columns) != sorted(df.columns):
        return f"columns {sorted(set(rel.columns) ^ set(df.columns))}"
    want = rows_of(rel.columns, rel.fetchall())
    if got == want:
        return None
    a, b = set(got), set(want)
    return f"rows {len(got)}/{len(want)}, only here {sorted(a - b)[:2]}, only SQL {sorted(b - a)[:2]}"


def connect(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


if __name__ == "__main__":
    from haulwatch.session import local_session

    spark = local_session("8")
    spark.sparkContext.setLogLevel("OFF")
    folder, names = sys.argv[1], sys.argv[2:] or list(entry.queries())
    con = connect(folder)
    for name in names:
        start = time.time()
        try:
            bad = compare(spark, con, folder, name) if name in entry.oracle_sql() else "no SQL"
        except Exception as error:  # noqa: BLE001
            bad = "ERR " + str(error)[:600].replace("\n", " | ")
        print(f"{name:28s} {time.time() - start:6.1f}s {'ok' if bad is None else bad}", flush=True)
