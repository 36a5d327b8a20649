"""Every query beside its SQL twin."""

import duckdb
import pytest

import __spark_entry__ as spark_entry
from tidemark.plans import oracle, queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries.all_queries()
SQL = oracle.all_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("lineitem", "events"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def normal(columns, rows):
    places = [columns.index(name) for name in sorted(columns)]
    return sorted(tuple(str(row[i]) for i in places) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    relation = duck.sql(SQL[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    got = normal(frame.columns, frame.collect())
    want = normal(relation.columns, relation.fetchall())
    assert got == want
    assert got


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(spark_entry.queries())
    assert set(SQL) <= set(spark_entry.oracle_sql())


def test_entry_has_rows(spark):
    assert spark_entry.entry(spark).count() > 0
