"""Every registered query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from tessera.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    return float(f"{v:.6g}") if isinstance(v, float) else v


def rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(plain(v) for v in r) for r in df.itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, name):
    got = catalogue.queries()[name](spark, SF).toPandas()
    want = duck.sql(catalogue.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
