"""Leaks against a look at every window."""

import random
from collections import Counter

import numpy as np

from tests.llm.helpers import corpus, lowered, prose, table, words
from turnout.llm import decontaminate as d


def plain(rows, items):
    """Every window of an item's size, or a shorter text as a whole, by the weighted similarity of its shingles.

    A shingle of the item weighs one over the items that hold it, any other as much as the mean of the item's own.
    """
    def bag(w, width):
        return Counter(tuple(w[i : i + width]) for i in range(len(w) - width + 1))

    own = {i: words(lowered(t)) for i, t in items if words(t)}
    bags = {i: bag(w, min(5, len(w))) for i, w in own.items()}
    holders = Counter(s for b in bags.values() for s in b)
    found = {}
    for n, (doc_id, text) in enumerate(rows):
        w = words(lowered(text))
        for i, item in own.items():
            b, best = bags[i], (0, 0)
            size, width = min(len(item), len(w)), min(5, len(item))
            mean = sum(k / holders[s] for s, k in b.items()) / b.total()
            for at in range(len(w) - size + 1):
                a = bag(w[at : at + size], width)
                if not a.keys() & b.keys():
                    continue
                weight = {s: 1 / holders[s] if s in b else mean for s in a | b}
                low = sum(weight[s] * min(a[s], b[s]) for s in a | b)
                high = sum(weight[s] * max(a[s], b[s]) for s in a | b)
                best = max(best, (round(low / high, 12), -at))
            if best[0] >= d.SIMILARITY:
                found[n, i] = doc_id, i, -best[1], size, round(best[0], 9)
    return sorted(found.values(), key=str)


def fixture():
    rng = random.Random(9)
    items = [(i, " ".join(prose(rng, n))) for i, n in enumerate((14, 30, 30, 57, 5, 3))]
    items += [(20, None), (21, "  "), (22, items[1][1] + " " + items[2][1])]
    rows = [r for r in corpus() if r[0] != 900]
    for i, text in items[:6]:
        rows.append((1000 + i, " ".join(prose(rng, 40)) + " " + text.upper() + " " + " ".join(prose(rng, 20))))
    near = items[3][1].split()
    near[20] = "changed"
    rows += [(2000, " ".join(near)), (2001, " ".join(items[3][1].split()[:20])), (2002, items[0][1])]
    return rows, items


def test_finds_what_a_look_at_every_window_finds(spark):
    rows, items = fixture()
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = d.leaks(table(spark, rows, "item_id", "similarity"), bench).collect()
    got = sorted([(*tuple(r)[:4], round(r.similarity, 9)) for r in found], key=str)
    assert got == plain(rows, items)
    assert {r.doc_id for r in found} >= {1000, 1001, 1002, 1003, 1004, 1005, 2000, 2002}
    assert 2001 not in {r.doc_id for r in found}


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rows, items = fixture()
    bench = spark.createDataFrame(items[:6], "item_id long, text string")
    monkeypatch.setattr(d, "ITEMS", 2)
    found = d.leaks(table(spark, rows), bench).collect()
    assert {r.item_id for r in found} == {0, 1, 2, 3, 4, 5}


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert d.leaks(table(spark, corpus()), bench).collect() == []
    assert d.leaks(table(spark, []), spark.createDataFrame([(1, "a b")], bench.schema)).collect() == []


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 2**63, 300).astype(np.uint64)
    queries = prints[rng.integers(0, 300, 400)].copy()
    for i in range(400):  # up to 26 bits away, in one block too
        for bit in rng.choice(64, rng.integers(0, 27), replace=False):
            queries[i] ^= np.uint64(1) << np.uint64(bit)
    queries[:16] = prints[:16] ^ np.uint64(0xFFFF)
    pairs = set(zip(*map(np.ndarray.tolist, d.HammingIndex(prints).within(queries))))
    near = np.argwhere(d.distance(queries[:, None], prints[None, :]) <= d.RADIUS)
    assert pairs == set(map(tuple, near.tolist()))


def _found(spark, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return sorted((r.doc_id, r.item_id, r.start_word, r.n_words, round(r.similarity, 9))
                  for r in d.leaks(table(spark, docs), bench).collect())


def test_weights_are_those_of_the_whole_benchmark(spark, monkeypatch):
    rng = random.Random(4)
    item = prose(rng, 40)
    changed = [*item[:20], "changed", *item[21:]]
    items = [(1, " ".join(item)), (2, " ".join(prose(rng, 30))), (3, " ".join(item))]
    docs = [(7, " ".join(prose(rng, 9) + changed + prose(rng, 9)))]
    expected = [(7, i, 9, 40, round(31 / 41, 9)) for i in (1, 3)]
    assert _found(spark, docs, items) == expected
    monkeypatch.setattr(d, "ITEMS", 1)
    assert _found(spark, docs, items) == expected


def test_windows_outside_the_radius_are_found(monkeypatch):
    rng = random.Random(5)
    item = prose(rng, 70)
    changed = [*item[:25], "changed", *item[26:]]
    none = np.empty(0, np.int64)
    monkeypatch.setattr(d.HammingIndex, "within", lambda self, queries: (none, none))
    found = d.Items([(1, " ".join(item), {})]).find(" ".join(["x", *changed, "y"]))
    assert found == {0: (round(61 / 71, 12), 1, 70)}



def test_texts_shorter_than_an_item(spark):
    item = prose(random.Random(6), 50)
    docs = [(1, " ".join(item[:45])), (2, " ".join(item[:30])), (3, " ".join(item[:3])), (4, " ".join(item[4:]))]
    assert _found(spark, docs, [(9, " ".join(item))]) == [
        (1, 9, 0, 45, round(41 / 46, 9)), (4, 9, 0, 46, round(42 / 46, 9))]


def test_the_index_alone_reaches_similar_windows():
    """Items whose shingles have 1, 4 or 16 holders, edited down to a similarity of 0.75 or more."""
    rng = random.Random(3)
    for holders in (1, 4, 16):
        reached = wanted = 0
        for trial in range(250):
            item = prose(rng, rng.randrange(25, 80))
            shingles = d.shingle_hashes(d.word_hashes(" ".join(item).encode()), 5)
            shared = {int(s): holders for s in shingles.view(np.int64)} if holders > 1 else {}
            items = d.Items([(1, " ".join(item), shared)])
            near = list(item)
            for _ in range(rng.randrange(1, 4)):
                near[rng.randrange(len(near))] = f"new{rng.randrange(10**6)}"
            window = d.shingle_hashes(d.word_hashes(" ".join(near).encode()), 5)
            if items.similarity(window, 0) < d.SIMILARITY:
                continue
            wanted += 1
            votes = d._votes(window, items.weights(window)).sum(axis=0, keepdims=True)
            queries, _ = items.by_size[len(item)][1].within(d._fingerprints(votes))
            reached += len(queries) > 0
        assert wanted > 50 and reached >= 0.99 * wanted, (holders, reached, wanted)


def test_index_tables_hold_small_numbers():
    index = d.HammingIndex(np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    assert all(owners.dtype.itemsize == 2 for _, owners in index.tables)
    queries, items = index.within(index.fingerprints)
    assert {(i, i) for i in range(1000)} <= set(zip(queries.tolist(), items.tolist(), strict=True))
