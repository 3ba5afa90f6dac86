"""Operators that know nothing of calls, on the order tables."""

import pytest
from pyspark.sql import functions as F

from tests.compare import connect, duck_rows, spark_rows
from turnout.functions import format_hms, hms_to_seconds
from turnout.operators import cleaning, encoding, profiles, quality, ranking


@pytest.fixture(scope="module")
def tables(spark, small):
    return lambda name: spark.read.parquet(f"{small}/{name}.parquet")


@pytest.fixture(scope="module")
def same(small):
    with connect(small) as con:
        def check(df, sql):
            assert spark_rows(df) == duck_rows(con, sql)
        yield check


def test_group_profile(tables, same):
    metrics = {"part": "l_partkey", "supplier": "l_suppkey"}
    stats = ("avg", "median", "min", "max")
    columns = ", ".join(
        f"{expr} as {stat}_{name}_sec" for name, c in metrics.items() for stat, expr in {
            "avg": f"avg({c})", "median": f"quantile_disc({c}, 0.5)",
            "min": f"min({c})", "max": f"max({c})"}.items())
    sql = f"select l_returnflag, l_linestatus, {columns}, count(*) as n from lineitem group by all"
    keys = ["l_returnflag", "l_linestatus"]
    same(profiles.group_profile(tables("lineitem"), keys, metrics, stats, "n"), sql)
    # A million rows of accuracy is exact here too.
    same(profiles.group_profile(tables("lineitem"), keys, metrics, stats, "n", 1_000_000), sql)


def test_dependency_violations(tables, same):
    df = quality.dependency_violations(tables("orders"), "o_custkey", "o_orderpriority")
    same(df.withColumn("values", F.array_join("values", ",")), """
        select o_custkey, array_to_string(list_sort(list(distinct o_orderpriority)), ',')
          as "values", count(distinct o_orderpriority) as num_values
        from orders group by o_custkey having count(distinct o_orderpriority) > 1""")


@pytest.mark.parametrize("mode, first", [("index", 0), ("dense_rank", 1)])
def test_encode_category(tables, same, mode, first):
    df = encoding.encode_category(tables("orders"), "o_orderpriority", "code", mode)
    same(df.select("o_orderkey", "code"), f"""
        select o_orderkey, dense_rank() over (order by o_orderpriority) - 1 + {first} as code
        from orders""")


def test_encode_category_with_many_values(tables, same):
    df = encoding.encode_category(tables("part"), "p_name", "code")
    same(df.select("p_partkey", "code"), """
        select p_partkey, dense_rank() over (order by p_name) - 1 as code from part""")


def test_dedup(tables, same):
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"]
    same(cleaning.dedup_most_complete(tables("lineitem").select(*columns), "l_orderkey"), f"""
        select {', '.join(columns)} from (select *, row_number() over (partition by l_orderkey
          order by l_partkey, l_suppkey, l_linenumber, l_returnflag) as rn from lineitem)
        where rn = 1""")


def test_top_k_and_top_bottom(tables, same):
    orders = tables("orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    same(ranking.top_k(orders, "o_totalprice", 7, ties=["o_orderkey"]), """
        select o_orderkey, o_orderpriority, o_totalprice from orders
        order by o_totalprice desc, o_orderkey limit 7""")
    picked = ranking.top_bottom_k(
        orders, ["o_orderpriority"], "o_totalprice", 3, ["o_orderkey"], ("low", "high"))
    same(picked.drop("GROUP_ORDER"), """
        with r as (select o_orderkey, o_orderpriority, o_totalprice,
          row_number() over (partition by o_orderpriority order by o_totalprice, o_orderkey) as lo,
          row_number() over (partition by o_orderpriority
            order by o_totalprice desc, o_orderkey) as hi from orders)
        select o_orderkey, o_orderpriority, o_totalprice, 'low' as GROUP_TYPE from r where lo <= 3
        union all
        select o_orderkey, o_orderpriority, o_totalprice, 'high' from r where hi <= 3""")


def test_texts_of_keys(tables):
    df = tables("orders").select("o_orderkey", format_hms("o_orderkey").alias("t"))
    assert df.where(hms_to_seconds("t") != F.col("o_orderkey")).count() == 0
