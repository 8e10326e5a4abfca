"""Queries of the subpackage that have SQL, against it."""

import pytest

from fieldlight.llm.queries import oracle_sql, queries

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equal(spark, sf_dir, name):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    got, want = queries()[name](spark, sf_dir), con.sql(oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(tuple(r[c] for c in want.columns) for r in got.collect()) == sorted(want.fetchall())
