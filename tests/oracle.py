"""Comparison of a query with its SQL on the other engine."""

import glob
import math
import os

import duckdb


def connect(sf: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def plain(v):
    if v is None or isinstance(v, (str, bool)):
        return (str(type(v).__name__)[:1], str(v))
    x = float(v)
    return ("n", "nan" if math.isnan(x) else f"{x:.9g}")


def rows_of(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def same(spark, sf, query, sql):
    df = query(spark, sf)
    other = connect(sf).execute(sql)
    columns = [c[0] for c in other.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(other.fetchall(), columns)
