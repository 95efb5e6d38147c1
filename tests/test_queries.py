"""Every registered query against its SQL on the same parquet files."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from shardleaf import workload

QUERIES, SQL = workload.queries(), workload.oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS FROM '{sf}/{f}'")
    return con


def table(df):
    def text(v):
        if v is None or v is pd.NaT or v != v:
            return "~"
        return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    df = df[sorted(df.columns)]
    return sorted(tuple(text(v) for v in r) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, db, sf, name):
    ours, theirs = QUERIES[name](spark, sf).toPandas(), db.sql(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(theirs), "the query should find something"
    assert table(ours) == table(theirs)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["qid", "n_matches", "n_targets", "no_match"]
    assert df.where("n_matches > 0").count() > 0
