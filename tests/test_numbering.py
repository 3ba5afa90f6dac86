"""Ranks in slices against the window's, and cells of bounded size."""

import random

import pytest

from turnout.operators import numbering as n, quality as q


@pytest.mark.parametrize("slices", [2, 16, 64])
def test_ranks_in_slices_are_the_window_s(spark, slices):
    rng = random.Random(slices)
    rows = [("hot", rng.choice([None, float(rng.randrange(300)), rng.random()]), i) for i in range(2000)]
    rows += [(None, float(rng.randrange(5)), i) for i in range(2000, 2400)]
    rows += [(f"k{i % 90}", rng.random(), i) for i in range(2400, 3000)] + [("ties", 1.0, i) for i in range(3000, 3100)]
    rows += [("nulls", None, i) for i in range(4000, 4005)]
    df = spark.createDataFrame(rows, "k string, v double, id bigint").repartition(6)
    args = (["k"], "v", ["id"])
    expected = sorted(map(str, map(tuple, n.rank_groups(df, *args).collect())))
    assert sorted(map(str, map(tuple, n.ranks_in_slices(df, *args, slices=slices).collect()))) == expected


def test_ranks_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, v double, id bigint")
    assert n.ranks_in_slices(df, ["k"], "v", ["id"]).collect() == []


def pairs(spark):
    rows = [("big", str(i % 250)) for i in range(1000)] + [("two", "a"), ("two", "b"), ("two", None)]
    rows += [("one", "a"), (None, "x"), (None, "y"), ("none", None), ("exact", "1"), ("exact", "2"), ("exact", "3")]
    return rows, spark.createDataFrame(rows, "k string, v string").repartition(5)


@pytest.mark.parametrize("size", [1, 3, 40, 1000])
def test_cells_hold_every_value_and_no_more_than_their_size(spark, size):
    rows, df = pairs(spark)
    wanted = {}
    for k, v in rows:
        wanted.setdefault(k, set()).update({v} - {None})
    cells = q.dependency_cells(df, "k", "v", "vs", "n", size=size).collect()
    found = {}
    for c in cells:
        assert len(c.vs) <= size and c.vs == sorted(c.vs) and c.n == len(wanted[c.k])
        assert not found.setdefault(c.k, set()) & set(c.vs)
        found[c.k] |= set(c.vs)
    assert found == wanted
    for k, values in wanted.items():
        chunks = sorted(c.chunk for c in cells if c.k == k)
        assert chunks == list(range(max(1, -(-len(values) // size))))
    broken = q.dependency_violations(df, "k", "v", "vs", "n", size=size).collect()
    assert {r.k for r in broken} == {k for k, values in wanted.items() if len(values) > 1}
    assert sum(len(r.vs) for r in broken) == sum(len(v) for v in wanted.values() if len(v) > 1)
    assert [r.n for r in broken] == sorted((r.n for r in broken), reverse=True)


def test_nothing_gathers_without_a_bound(spark):
    _, df = pairs(spark)
    for made in (q.dependency_map(df, "k", "v"), q.dependency_violations(df, "k", "v")):
        text = made._jdf.queryExecution().optimizedPlan().toString()
        at = text.index("collect_list")
        # What is gathered is grouped by key and chunk.
        line = text[text.rindex("Aggregate [", 0, at):at]
        assert "chunk#" in line.split("]")[0]
