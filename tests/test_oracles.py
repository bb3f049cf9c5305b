"""Every query against DuckDB over the same tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_agrees_with_sql(spark, duck, name):
    frame = queries()[name](spark, SF_DIR)
    got = frame.collect()
    result = duck.execute(oracle_sql()[name])
    columns = [item[0] for item in result.description]
    kinds = {item[0]: str(item[1]) for item in result.description}
    assert {c: KINDS[kind] for c, kind in frame.dtypes} == kinds
    expected = rows_of(columns, result.fetchall())
    actual = rows_of(frame.columns, got)
    assert len(got) == sum(expected.values())
    assert list((actual - expected).items())[:3] == list((expected - actual).items())[:3] == []


def test_flagship_has_rows(spark):
    assert entry(spark).count() > 0
