"""Every query of the catalogue against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from hydrapix.plans import catalogue

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 6) + 0.0)
    return str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return c


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = duck.sql(catalogue.ORACLE_SQL[name])
    assert sorted(want.columns) == cols
    at = [want.columns.index(c) for c in cols]
    got = sorted(tuple(map(plain, r)) for r in df.select(*cols).collect())
    assert got and got == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1
