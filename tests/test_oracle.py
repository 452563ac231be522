"""Every query with an SQL twin gives the same rows in both engines; the others give rows."""

import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from themata.checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
SLOW = {"gmm_full", "gmm_diag", "svm_linear", "svm_rbf", "svm_poly", "mlp", "random_forest"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.sql(f"create view {file.removesuffix('.parquet')} as select * from '{SF}/{file}'")
    return con


def normal(df):
    df = df[sorted(df.columns)].copy()
    for column in df.columns:
        if df[column].dtype == object:
            df[column] = df[column].astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, duck, name):
    ours = QUERIES[name](spark, SF).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(ours) > 0
        return
    theirs = duck.sql(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) == len(theirs)
    ours, theirs = normal(ours), normal(theirs)
    for column in ours.columns:
        a, b = ours[column].to_numpy(), theirs[column].to_numpy()
        same = (a == b) | ((a != a) & (b != b))
        assert np.all(same), (column, a[~same][:3], b[~same][:3])


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 50
    assert [r["var"] for r in rows] == sorted((r["var"] for r in rows), reverse=True)
