"""Every registered query that SQL can express gives the rows and types of its SQL counterpart."""

import pytest

import oracle_queries
import registry
from tests import oracle

STATEMENTS = oracle_queries.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    return oracle.connect(data)


@pytest.mark.parametrize("name", STATEMENTS)
def test_same_result(spark, data, duck, name):
    df = registry.queries()[name](spark, data)
    result = duck.execute(STATEMENTS[name])
    types = [(d[0], d[1]) for d in result.description]
    assert oracle.kinds(df.schema, types) == []
    assert oracle.differences(df.toPandas(), result.df()) == []


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(registry.queries())


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
