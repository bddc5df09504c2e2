"""Every registered query against its SQL, by value, at two scales."""

import datetime
import math
import os
from decimal import Decimal

import duckdb
import pytest

from spendgrain.catalog.oracle import ORACLE
from spendgrain.catalog.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem".split()
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return connection


def canonical(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else repr(value))
    if isinstance(value, datetime.datetime):
        return ("timestamp", value.isoformat())
    return (type(value).__name__, str(value))


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(canonical(r[i]) for i in order) for r in data])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    found = rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLE:
        assert found
        return
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    expected = rows(columns, cursor.fetchall())
    assert len(found) == len(expected)
    different = [(a, b) for a, b in zip(found, expected, strict=True) if a != b]
    assert not different, different[:3]


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
