"""Packing: ids against the library, every id in one piece, sequences without gaps, little padding."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import corpus, table
from tests.llm.test_tokenizers import texts
from turnout.llm import packing, queries
from turnout.llm.word_ids import VOCABULARY, WordIds

LIBRARY = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


def ids_of(text):
    found = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return np.asarray([*found, packing.END], "<u4").tobytes()


def test_ids_are_the_library_s():
    own = WordIds(public_tokenizers.path(VOCABULARY))
    odd = [*texts(), *(t for _, t in corpus()), "ΟΔΟΣ ΟΔΟΣ. Σ", "x's 'S ''s", "a<|endoftext|>b <|nothing|>", "é ́e"]
    expected = [ids_of(t)[:-4] for t in odd]
    assert own(odd) == expected
    assert [own([t])[0] for t in odd] == expected


@given(st.integers(1, 20_000))
@settings(deadline=None)
def test_cuts(n):
    lengths = packing.cuts(n)
    assert sum(lengths) == n
    assert all(0 < x <= packing.CAPACITY and (x & (x - 1) == 0 or x < packing.LEAST) for x in lengths)
    assert sum(x < packing.LEAST for x in lengths) <= 1


@given(st.lists(st.integers(1, 64), max_size=60))
def test_common_bins(lengths):
    fill = Counter()
    for b, x in zip(packing.common_bins(lengths, 64), lengths, strict=True):
        fill[b] += x
    assert sorted(fill) == list(range(len(fill))) and all(v <= 64 for v in fill.values())
    assert sum(v <= 32 for v in fill.values()) <= 1


def check(rows, docs, capacity=packing.CAPACITY):
    """Every promise of the result; returns padding and ids."""
    encoded = Counter()
    for doc_id, text in docs:
        encoded[doc_id, ids_of(text)] += 1
    crcs = defaultdict(Counter)
    for r in rows:
        crcs[r.doc_id, r.doc_tokens][r.start, r.length, r.ids_crc32] += 1
    for (doc_id, raw), copies in encoded.items():
        found = crcs[doc_id, len(raw) // 4]
        start = 0
        for length in packing.cuts(len(raw) // 4, capacity):
            key = start, length, zlib.crc32(raw[4 * start : 4 * (start + length)])
            assert found[key] >= copies
            found[key] -= copies
            start += length
    assert not any(+c for c in crcs.values())
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding, sum(r.length for r in rows)


def test_packing(spark):
    docs = corpus() + list(enumerate(texts(), 5000))
    df = table(spark, docs, "start", "class", "worker", "number", "sequence_id", "rank").repartition(5)
    padding, ids = check(packing.packing(df).collect(), docs)
    assert padding <= packing.CAPACITY + ids / packing.LEAST * 2


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, ""), (None, "")], [(7, "word " * 5000)] * 3])
def test_odd_tables(spark, rows):
    check(packing.packing(table(spark, rows)).collect(), rows)


def test_one_length_holds_a_third(spark):
    docs = [(i, "x " * 99) for i in range(300)] + [(1000 + i, "y " * (i % 70)) for i in range(600)]
    padding, ids = check(packing.packing(table(spark, docs).repartition(7)).collect(), docs)
    assert padding < 0.06 * ids + packing.CAPACITY


def test_query_on_the_supplied_table(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    padding, ids = check(queries.op13_packing(spark, small).collect(), docs)
    assert padding < 0.01 * ids + packing.CAPACITY
