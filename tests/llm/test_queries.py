"""Every query over texts that SQL can express, against DuckDB; whole runs of the others."""

import duckdb
import pytest

from capplan.llm.oracles import ORACLES
from capplan.llm.queries import QUERIES
from tests.test_oracle import SF, TABLES, _bag


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    relation = duck.execute(ORACLES[name])
    columns = [column[0] for column in relation.description]
    expected = _bag(columns, relation.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert _bag(df.columns, df.collect()) == expected
    assert expected


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
