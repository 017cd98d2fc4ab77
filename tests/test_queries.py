"""Every registered query against its SQL, order-insensitive, at the smallest scale."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "labels",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{SF_DIR}/{table}.parquet')"
        )
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    ours = Counter(map(tuple, df.select(*columns).collect()))
    expected = duck.execute(contract.oracle_sql()[name])
    names = [field[0] for field in expected.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    theirs = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    assert ours == theirs
    assert ours


def test_entry(spark):
    assert contract.entry(spark).count() > 0
