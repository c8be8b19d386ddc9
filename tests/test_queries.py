"""Every engine query runs, and equals its oracle, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from corpgraph import catalog

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return con


def plain(df):
    cell = lambda v: "NULL" if pd.isna(v) else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, DATA).toPandas()
    if name in catalog.ORACLES:
        want = duck.execute(catalog.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(got) == plain(want)
    else:
        assert name == "exec_mentions" and len(got) > 0  # its own test holds it against brute force
