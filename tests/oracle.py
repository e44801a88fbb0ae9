"""Compares a registered query with its SQL on the same tables."""

import os

import duckdb
import numpy as np
import pandas as pd


def _plain(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and np.isnan(x)):
        return None
    if isinstance(x, (bool, np.bool_)):
        return bool(x)
    if isinstance(x, (int, np.integer)):
        return int(x)
    if isinstance(x, (float, np.floating)):
        return round(float(x), 6)
    if isinstance(x, (list, np.ndarray)):
        return str([_plain(y) for y in x])
    return str(x)


def rows(pdf):
    columns = sorted(pdf.columns)
    return columns, sorted([tuple(_plain(x) for x in r) for r in pdf[columns].itertuples(index=False, name=None)], key=str)


def compare(spark, name, query, sql, sf):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    want_columns, want = rows(con.execute(sql).df())
    columns, got = rows(query(spark, sf).toPandas())
    assert columns == want_columns, (name, columns, want_columns)
    assert len(got) == len(want), (name, len(got), len(want))
    for a, b in zip(got, want, strict=True):
        assert a == b, (name, columns, a, b)
    return len(got)
