"""Every registered query against its SQL twin, on whole tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from tests.conftest import DATA
from tidemark.plans.oracle import ORACLE as SQL
from tidemark.plans.queries import REGISTRY as QUERIES


@pytest.fixture(scope="module")
def sql_engine():
    connection = duckdb.connect()
    for name in os.listdir(f"{DATA}/sf0.001"):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS "
                           f"SELECT * FROM '{DATA}/sf0.001/{name}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return None if value is None else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


def test_each_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sql_engine, name):
    df = QUERIES[name](spark, f"{DATA}/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    result = sql_engine.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert table(df.columns, df.collect()) == table(names, result.fetchall())


def test_entry_is_the_profile(spark):
    df = entry(spark)
    assert df.count() == 150
    assert "CustomerRiskScore" in df.columns
