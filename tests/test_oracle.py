"""Every query against a second engine, value for value, and its physical plan."""

from concurrent.futures import ThreadPoolExecutor

import pytest

import __spark_entry__ as contract
from oracle import statements
from tests.compare import connect, duck_rows, spark_rows, type_differences
from turnout.plans import catalog

QUERIES = catalog.build()
SQL = statements()

NOT_IN_A_PLAN = (
    "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "Cartesian", "BroadcastNestedLoopJoin",
    "Scan ExistingRDD",
)


@pytest.fixture(scope="module")
def con(small):
    with connect(small) as connection:
        yield connection


@pytest.fixture(scope="module")
def results(spark, small):
    """Queries are small, so a few run side by side."""
    def run(query):
        df = query(spark, small)
        return df, spark_rows(df)

    with ThreadPoolExecutor(4) as pool:
        yield {name: pool.submit(run, query) for name, query in sorted(QUERIES.items())}
        pool.shutdown(cancel_futures=True)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches(results, con, name):
    df, (names, rows) = results[name].result()
    expected_names, expected = duck_rows(con, SQL[name])
    assert names == expected_names
    assert rows == expected
    assert rows
    assert type_differences(df, con, SQL[name]) == {}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [operator for operator in NOT_IN_A_PLAN if operator in plan] == []


def test_contract_has_every_query():
    assert set(QUERIES) <= set(contract.queries())
    assert SQL.items() <= contract.oracle_sql().items()


def test_entry(spark):
    assert contract.entry(spark).count() == 5
