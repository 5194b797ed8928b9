"""Rows of Spark and DuckDB in one comparable form."""

import glob
import math
import os

import duckdb


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, float) and v == int(v) and abs(v) < 1e15:
        return int(v)
    return v


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)


def duck_rows(sql, sf):
    with duckdb.connect() as c:
        for p in glob.glob(f"{sf}/*.parquet"):
            source = p if os.path.isfile(p) else f"{p}/*.parquet"
            c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{source}'")
        got = c.execute(sql)
        columns = [d[0] for d in got.description]
        order = sorted(range(len(columns)), key=lambda i: columns[i])
        return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in got.fetchall()), key=repr)
