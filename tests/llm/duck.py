"""Run a SQL counterpart over rows that are already in memory."""

import duckdb

from tests import oracle


def rows_of(statement, **tables):
    con = duckdb.connect()
    for name, table in tables.items():
        con.register(name, table.toArrow())
    return con.execute(statement).df()


def assert_same(df, statement, **tables):
    assert oracle.differences(df.toPandas(), rows_of(statement, **tables)) == []
