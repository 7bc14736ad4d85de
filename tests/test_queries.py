"""Every named query against its SQL, and its size where there is no SQL."""

import os

import compare
import pytest

import __spark_entry__

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = __spark_entry__.queries()
SQL = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF_DIR)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    kinds, rows = compare.spark_result(QUERIES[name](spark, SF_DIR))
    expected_kinds, expected = compare.duck_result(db, SQL[name])
    assert expected, "nothing is compared"
    assert kinds == expected_kinds
    assert rows == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
