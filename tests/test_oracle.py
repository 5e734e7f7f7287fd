"""Every query against its SQL counterpart in an independent engine."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import connect, spark_rows, sql_rows

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    con = connect(small)
    yield con
    con.close()


def test_every_statement_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, duck, small, name):
    columns, rows = spark_rows(QUERIES[name](spark, small))
    sql_columns, expected = sql_rows(duck, ORACLE[name])
    assert columns == sql_columns
    assert rows == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_counterpart(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 166
