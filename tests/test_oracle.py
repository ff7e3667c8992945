"""Every registered query against its SQL, in an independent engine, on whole tables."""

from __future__ import annotations

import pytest

from checks import compare, oracle, queries

STATEMENTS = oracle.statements()
QUERIES = queries.registered()


@pytest.fixture(scope="module")
def connection(tables):
    return compare.connect(tables)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == STATEMENTS.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, tables, connection, name):
    df = QUERIES[name](spark, tables)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("Cartesian", "NestedLoop", "Python", "InPandas"):
        assert bad not in plan
    assert not compare.difference(df, connection, STATEMENTS[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 180
