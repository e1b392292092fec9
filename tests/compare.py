"""Compare a query with its DuckDB counterpart."""

import math
import os

import duckdb

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (bool, int)):
        return v
    return round(float(v), 9) if isinstance(v, float) else str(v)


def rows(columns, found):
    at = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted([columns[k] for k in at] for _ in [0]), sorted(repr([plain(r[k]) for k in at]) for r in found)


def spark_rows(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(sql, folder=SF):
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{folder}/{f}'")
    got = con.sql(sql)
    return rows(got.columns, got.fetchall())
