"""Comparing a query with its SQL on the same Parquet tables."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

DATA = "/root/testdata/sf0.001"

needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


def plain(value):
    if value is None or value is pd.NA or value is pd.NaT:
        return None
    if hasattr(value, "tolist") and not isinstance(value, (str, bytes)):
        value = value.tolist()
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return int(value) if math.isfinite(value) and value == int(value) else round(value, 5)
    return value


def rows(frame):
    names = sorted(frame.columns)
    return names, sorted(repr(tuple(plain(x) for x in r)) for r in frame[names].itertuples(index=False, name=None))


def check(spark, query, sql):
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    assert rows(query(spark, DATA).toPandas()) == rows(con.execute(sql).fetchdf())
