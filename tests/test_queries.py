"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from bankflow.checks.queries import QUERIES as BANK_QUERIES

SF_DIR = "/root/testdata/sf0.001"

ORACLES = entry_points.oracle_sql()
QUERIES = {name: query for name, query in entry_points.queries().items() if name in BANK_QUERIES or name in ORACLES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def test_every_bank_query_has_sql():
    assert set(BANK_QUERIES) <= set(ORACLES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    expected_columns = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(expected_columns)
    order = sorted(df.columns)
    positions = [expected_columns.index(c) for c in order]
    expected = sorted((tuple(r[p] for p in positions) for r in cursor.fetchall()), key=repr)
    found = sorted((tuple(r) for r in df.select(*order).collect()), key=repr)
    assert found == expected


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == [
        "AccountID", "TransactionID", "PaymentID", "Suspicious", "CreditScore", "TotalFlaggedEvents"
    ]
    assert df.count() > 0
