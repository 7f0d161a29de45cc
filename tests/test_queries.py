"""Every query against its SQL equivalent in DuckDB, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from cohortscope.plans.oracle import ORACLE_SQL
from cohortscope.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    cursor = duck.execute(contract.oracle_sql()[name])
    described = {d[0]: str(d[1]) for d in cursor.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == described
    columns = sorted(described)
    order = [list(described).index(c) for c in columns]
    expected = sorted(repr([r[i] for i in order]) for r in cursor.fetchall())
    found = sorted(repr([r[c] for c in columns]) for r in df.collect())
    assert found == expected and found


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "delta_vs_ceu" in df.columns
