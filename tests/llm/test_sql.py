"""Queries that SQL can express, on a supplied table."""

import pytest

from tests.compare import connect, duck_rows, spark_rows, type_differences
from turnout.llm import queries


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_matches(spark, small, name):
    df = queries.build()[name](spark, small)
    with connect(small) as con:
        statement = queries.statements()[name]
        assert spark_rows(df) == duck_rows(con, statement)
        assert type_differences(df, con, statement) == {}
