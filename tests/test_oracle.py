"""Every query with SQL gives the same rows as DuckDB over the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from tallyforge.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def plain(v):
    if hasattr(v, "quantize"):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    mine = sorted((tuple(map(plain, r)) for r in df.select(cols).collect()), key=str)
    cur = con.execute(SQL[name])
    theirs = [d[0] for d in cur.description]
    assert sorted(theirs) == cols
    at = [theirs.index(c) for c in cols]
    assert mine == sorted((tuple(plain(r[i]) for i in at) for r in cur.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
