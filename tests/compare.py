"""Comparison of a query's rows with those of its SQL in DuckDB."""

import glob
from decimal import Decimal
from pathlib import Path

import duckdb


def connection(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {Path(f).stem} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, float | Decimal):
        return repr(round(float(v), 6))
    return repr(list(v)) if isinstance(v, list | tuple) else repr(v)


def rows_of_query(df):
    names = sorted(df.columns)
    return names, sorted(tuple(plain(r[c]) for c in names) for r in df.collect())


def rows_of_sql(con, sql):
    found = con.sql(sql)
    names = sorted(found.columns)
    at = [found.columns.index(c) for c in names]
    return names, sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())
