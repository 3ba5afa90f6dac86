"""The similarity join against all pairs."""

import itertools

from tests.llm.helpers import corpus, lowered, table, unique_ids, words
from turnout.llm import components as c, jaccard_join as j
from turnout.llm.components import components


def shingles(text):
    w = words(lowered(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def plain(texts):
    sets = {d: shingles(t) for d, t in texts.items()}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_groups_are_those_of_all_pairs(spark):
    rows = corpus()
    found = j.similar_groups(table(spark, rows, "n", "token", "h1", "class_id", "component")).collect()
    assert len(found) == len(unique_ids(rows))
    expected = plain(unique_ids(rows))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert sum(c != d for d, (_, c) in expected.items()) > 10


def test_empty_table(spark):
    assert j.similar_groups(table(spark, [])).collect() == []


def test_prefix_sizes():
    for n in range(1, 300):
        need = j.need(n)
        assert 100 * need >= 75 * n > 100 * (need - 1)
        assert n - need + 1 <= j.posted(n) <= n


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.component for r in components(df, "a", "b").collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}


def test_links_that_are_stars_take_no_round(spark, monkeypatch):
    rounds, star = [], c._star
    monkeypatch.setattr(c, "_star", lambda edges, large: rounds.append(large) or star(edges, large))
    df = spark.createDataFrame([(1, 2), (3, 1), (3, 1), (7, 8)], "a long, b long")
    assert {r.node: r.component for r in components(df, "a", "b").collect()} == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7}
    assert not rounds
    df = spark.createDataFrame([(5, 6), (4, 6)], "a long, b long")
    assert {r.node: r.component for r in components(df, "a", "b").collect()} == {4: 4, 5: 4, 6: 4}
    assert rounds == [True, False]


def test_shuffles_are_freed_after_each_large_step(spark, monkeypatch):
    steps = []
    for name in ("stored", "free_shuffles", "_possible", "_verified"):
        old = getattr(j, name)
        monkeypatch.setattr(j, name, lambda *a, f=old, n=name: steps.append((n, getattr(a[0], "columns", None))) or f(*a))
    j.similar_groups(table(spark, corpus())).collect()
    for kind in ({"token"}, {"doc_id"}, {"doc_id", "n", "h1", "h2", "tokens", "bits"}, {"a", "b"}):
        then = [then for (name, columns), (then, _) in zip(steps, steps[1:]) if name == "stored" and set(columns) == kind]
        assert then and set(then) == {"free_shuffles"}, kind
