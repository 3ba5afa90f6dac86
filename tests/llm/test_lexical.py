"""Ranked search against a plain scoring of every document for every item."""

import math
import random
import re
import tracemalloc
from collections import Counter
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import corpus, lowered, prose, table
from turnout.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(lowered(text))


def brute(docs, items, k=10):
    bags = [(doc_id, Counter(terms(text))) for doc_id, text in docs if terms(text)]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    rows = []
    for item_id, text in items:
        scored = []
        for doc_id, bag in bags:
            m, score = 100 - 75 + 75 * sum(bag.values()) * n_docs // n_terms, 0
            for t in terms(text):
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m))
            if score:
                scored.append((-score, doc_id is None, doc_id))
        rows += [(item_id, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[:2], x[2] or 0))[:k])]
    return sorted(rows, key=str)


def found(spark, docs, items, k=10, **names):
    items = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    df = table(spark, docs, "term", "key", "score", "rank").repartition(4)
    return sorted(map(tuple, lexical.ranked(df, items, k=k, **names).collect()), key=str)


def asked(docs, seed=2):
    rng = random.Random(seed)
    items = [(i, " ".join((t or "").split()[:40])) for i, (_, t) in enumerate(docs[:30])]
    items += [(90, "no_such_word_anywhere"), (91, None), (92, " . "), (93, "One two THREE two"), (None, "a one")]
    items += [(94, "b-" + " ".join(prose(rng, 25)))] * 2
    return items


@pytest.mark.parametrize("segment, step, together", [(1 << 20, 32, 1024), (300, 1, 4)])
def test_as_brute_force(spark, monkeypatch, segment, step, together):
    monkeypatch.setattr(lexical, "STEP", step)
    docs = corpus()
    items = asked(docs)
    segments, blocks = lexical._indexed, lexical._item_terms

    # What workers run is sent by value only where it is made here.
    def small_segments(batches):
        lexical.SEGMENT, lexical.STEP = segment, step
        return segments(batches)

    def small_blocks(batches):
        lexical.ITEMS = together
        return blocks(batches)

    monkeypatch.setattr(lexical, "_indexed", small_segments)
    monkeypatch.setattr(lexical, "_item_terms", small_blocks)
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, docs, items, k=3) == brute(docs, items, k=3)


def test_ties_repeats_and_empty_tables(spark):
    docs = [(i, "same words here") for i in range(40, 0, -1)] + [(None, "same words"), (None, "same words here")]
    docs += [(5, "same words here"), (70, "others"), (71, None), (72, "")]
    items = [(1, "same"), (2, "words same same"), (3, "others")]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, [], items) == [] and found(spark, docs, []) == []
    assert found(spark, [(1, None)], items) == []


def test_a_very_long_text_and_letters_beyond_ascii(spark):
    docs = [(1, "Ärger ärger ÄRGER x_y z0 " + "pad " * 400_000), (2, "ärger z0"), (3, "x y ÄRGER"), (4, "日本 日本")]
    items = [(1, "ärger X-y"), (2, "ÄRGER pad"), (3, "日本"), (4, "Z0 z0")]
    assert found(spark, docs, items) == brute(docs, items)


def lists_of(docs, query):
    segment = lexical._segment(*zip(*[(d, lexical.term_hashes(t)) for d, t in docs], strict=True))
    row = {c: segment.column(c)[0].values.to_numpy() for c in segment.schema.names}
    hashes, repeats = np.unique(lexical.term_hashes(query), return_counts=True)
    lengths = row["lengths"]
    df = dict(zip(row["terms"].tolist(), row["sizes"].tolist(), strict=True))
    w = [math.floor(1000 * math.log((2 * len(lengths) + 2) / (2 * df.get(h, 0) + 1))) for h in hashes.tolist()]
    held = lexical.Lists(row, hashes, np.asarray(w, np.int64), len(lengths), int(lengths.sum()))
    return held, repeats, row["doc_ids"]


def test_stops_before_the_ends_of_the_lists():
    rng = random.Random(4)
    docs = [(i, " ".join(["common", "other"][: 1 + i % 2] + prose(rng, 5 + i % 90))) for i in range(3000)]
    docs += [(9000 + i, "common other rare word " + " ".join(prose(rng, i))) for i in range(12)]
    held, repeats, ids = lists_of(docs, "common other rare word")
    read = 0
    advance = held._advance

    def counting(best, end, seen, width):
        nonlocal read
        read = int(seen.sum())
        advance(best, end, seen, width)

    held._advance = counting
    scores, top = held.search(np.arange(4), repeats, ids, 10, 0)
    expected = brute(docs, [(0, "common other rare word")])
    assert sorted(zip(ids[top].tolist(), scores.tolist())) == sorted((d, s) for _, _, d, s in expected)
    assert 0 < read < len(held.docs) / 4


def test_a_floor_keeps_ties_with_it():
    docs = [(i, "one two") for i in range(50)]
    held, repeats, ids = lists_of(docs, "one")
    scores, top = held.search(np.arange(1), repeats, ids, 10, 0)
    assert ids[top].tolist() == list(range(10))
    again, _ = held.search(np.arange(1), repeats, ids, 10, int(scores[-1]))
    assert again.tolist() == scores.tolist()
    assert len(held.search(np.arange(1), repeats, ids, 10, int(scores[-1]) + 1)[0]) == 0


def test_long_documents_keep_their_norm_in_integers():
    lengths = np.asarray([1, 10**9], np.int64)
    assert lexical.length_norms(lengths, 10**9, 10**10).tolist() == [25 + 75 * n // 10 for n in (1, 10**9)]


def test_each_segment_is_a_row_group(spark, monkeypatch):
    def small_segments(batches):
        usual, lexical.SEGMENT = lexical.SEGMENT, 300
        yield from lexical._indexed(batches)  # in a worker this is the module's own
        lexical.SEGMENT = usual

    monkeypatch.setattr(lexical, "_indexed", small_segments)
    docs = corpus()
    stored = lexical.index(table(spark, docs).coalesce(1))
    files = [pq.ParquetFile(unquote(urlparse(f).path)).metadata for f in stored.inputFiles()]
    assert sum(f.num_rows for f in files) > 5
    assert [f.num_row_groups for f in files] == [f.num_rows for f in files]
    items = asked(docs)
    assert found(spark, docs, items) == brute(docs, items)


def test_sizes_of_terms_by_segment():
    segments = [lexical._segment([1, 2], [lexical.term_hashes(t) for t in texts]) for texts in (("a b", "b b"), ("c", "a c"))]
    batch = pa.Table.from_batches(segments).combine_chunks().to_batches()[0].select(["terms", "sizes"])
    rows = [r for b in lexical._term_sizes([batch, batch.slice(1)]) for r in zip(*b.to_pydict().values())]
    a, b, c = lexical.term_hashes("a b c").tolist()
    assert sorted(rows) == sorted([(a, 1), (b, 2), (a, 1), (c, 2), (a, 1), (c, 2)])


def test_a_long_item_over_short_documents(monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(1000)]
    docs = [(i, " ".join(rng.sample(words, 7))) for i in range(20_000)]
    held, repeats, ids = lists_of(docs, " ".join(words))
    tracemalloc.start()
    found = [x.tolist() for x in held.search(np.arange(1000), repeats, ids, 10, 0)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
    for cells in (1 << 40, 5000, 100):
        monkeypatch.setattr(lexical, "CELLS", cells)
        assert [x.tolist() for x in held.search(np.arange(1000), repeats, ids, 10, 0)] == found
