"""Every query against its SQL twin, at the smallest scale."""

import glob
import math
import os

import pytest

from fieldlight.plans.queries import queries
from fieldlight.plans.sql import ORACLE_SQL

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v + 0.0 if isinstance(v, float) else v


def test_every_query_has_sql():
    assert set(queries()) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equal(spark, sf_dir, con, name):
    got = queries()[name](spark, sf_dir)
    want = con.sql(ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda it: sorted(it, key=repr)
    ours = rows(tuple(plain(r[c]) for c in columns) for r in got.collect())
    order = [want.columns.index(c) for c in columns]
    theirs = rows(tuple(plain(r[i]) for i in order) for r in want.fetchall())
    assert ours == theirs
