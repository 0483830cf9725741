"""Each registered query against its SQL form, on the given tables."""

from __future__ import annotations

import duckdb
import pytest
from conftest import DATA, plan

import __spark_entry__ as contract
from rankweave.plans.queries import ORACLE, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SQL_TYPES = {"bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"}, "boolean": {"BOOLEAN"}}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return connection


def ordered(columns, data):
    places = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(row[p] for p in places) for row in data), key=repr)


def test_entry(spark):
    got = contract.entry(spark)
    assert got.columns == ["metric", "rank", "l_orderkey", "total"]
    assert got.count() == 20


def test_every_sql_form_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    # those of the corpus operators, where they are there, have their own tests
    assert set(QUERIES) - set(ORACLE) == {"q22_leaderboard"}


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, database, name):
    df = contract.queries()[name](spark, str(DATA))
    physical = plan(df)
    assert "CartesianProduct" not in physical and "NestedLoopJoin" not in physical
    got = [tuple(row) for row in df.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    want = database.sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    types = dict(zip(want.columns, map(str, want.types)))
    for column, kind in df.dtypes:
        assert types[column] in SQL_TYPES[kind], column
    assert ordered(df.columns, got) == ordered(want.columns, want.fetchall())

