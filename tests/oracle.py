"""Compares a query with its SQL, run by DuckDB on the same tables."""

import math
from pathlib import Path

import duckdb
import numpy as np

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return [plain(x) for x in v]
    if isinstance(v, float) and math.isfinite(v):
        return round(v, 9)
    return v


def rows(df_rows, columns, wanted):
    at = [columns.index(c) for c in wanted]
    return sorted(repr([plain(r[i]) for i in at]) for r in df_rows)


def same(spark, query, sql, sf=SF):
    df = query(spark, sf)
    con = duckdb.connect()
    for p in Path(sf).iterdir():
        con.execute(f"create view {p.stem} as select * from '{p}'")
    rel = con.sql(sql)
    assert sorted(rel.columns) == sorted(df.columns)
    got = rows([tuple(r) for r in df.collect()], df.columns, sorted(df.columns))
    assert got == rows(rel.fetchall(), list(rel.columns), sorted(df.columns))
    return len(got)
