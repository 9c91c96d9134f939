"""Every registered query against DuckDB on the same tables, row by row."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from workloads.queries import QUERIES as OWN

SF = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def _plain(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda index: columns[index])
    return Counter(tuple(_plain(row[index]) for index in order) for row in rows)


def test_every_query_has_an_oracle():
    """Queries over texts, where they are present, have tests of their own."""
    assert set(OWN) <= set(QUERIES) and set(OWN) <= set(ORACLES)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(OWN))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    relation = duck.execute(ORACLES[name])
    columns = [column[0] for column in relation.description]
    expected = _bag(columns, relation.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert _bag(df.columns, df.collect()) == expected
    assert expected


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["model_run", "sitetret", "grouping", "total"]
    assert df.count() > 0
