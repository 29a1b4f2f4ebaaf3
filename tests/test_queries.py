"""Every query against its SQL at sf0.001, and the flagship's promise."""

import math

import duckdb
import pytest

import __spark_entry__
from cairnflow import queries as core

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as from '{SF}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return tuple(map(norm, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(core.queries()))
def test_query(spark, duck, name):
    df = core.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    sql = core.oracle_sql().get(name)
    if sql:
        rel = duck.sql(sql)
        assert sorted(rel.columns) == cols
        at = [rel.columns.index(c) for c in cols]
        assert got == sorted((tuple(norm(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    else:
        assert got


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "to_month" in df.columns
    assert set(core.oracle_sql()) <= set(core.queries())
