"""Comparing a query with its SQL, however rows and columns are ordered."""

from __future__ import annotations

import decimal
import glob
import os


def cell(x):
    if x is None:
        return "~"
    if x != x:
        return "nan"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return str(x) if abs(x) == float("inf") else str(int(x)) if x == int(x) and abs(x) < 1e15 else f"{x:.10g}"
    if isinstance(x, list):
        return str([cell(y) for y in x])
    return str(x)


def rows(table):
    names = sorted(table.column_names)
    columns = [[cell(v) for v in table[n].to_pylist()] for n in names]
    return names, sorted(zip(*columns, strict=True)) if columns else []


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def compare(spark, con, query, sql, folder):
    ours, theirs = rows(query(spark, folder).toArrow()), rows(con.sql(sql).to_arrow_table())
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]
