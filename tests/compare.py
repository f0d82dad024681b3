"""Rows of a Spark result and of its SQL, in a form that can be compared."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return repr(round(value, 9))
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


def run_sql(sql, sf):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    result = con.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def same(df, sql, sf):
    names, expected = run_sql(sql, sf)
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, got) == rows_of(names, expected)
