"""Removed passages against a plain count of windows."""

import hashlib

import numpy as np

from tests.llm.helpers import corpus, table, words
from turnout.llm import substrings as s


def plain(rows):
    first = {}
    for doc_id, text in rows:
        w = words(text)
        for i in range(len(w) - 49):
            if doc_id is not None:
                first[tuple(w[i : i + 50])] = min(doc_id, first.get(tuple(w[i : i + 50]), doc_id))
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if doc_id is not None and first[tuple(w[i : i + 50])] < doc_id:
                gone[i : i + 50] = [True] * 50
        out.append((doc_id, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def test_removes_what_an_earlier_document_has(spark):
    rows = corpus()
    df = table(spark, rows, "version", "starts", "place", "kept")
    expected = plain(rows)
    found = [tuple(r) for r in s.without_repeats(df).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert sum(e[2] > 0 for e in expected) > 10
    digests = [tuple(r) for r in s.without_repeats(df, digest=True).collect()]
    assert sorted(digests, key=str) == sorted(
        [(*e[:3], hashlib.sha256(e[3].encode()).hexdigest()) for e in expected], key=str)


def test_stripped_keeps_columns_and_untouched_texts(spark):
    rows = [r for r in corpus() if r[0] is not None]
    df = table(spark, rows, "lang")
    texts = dict(zip([(d, t) for d, t in rows], [e[2:] for e in plain(rows)]))
    back = s.stripped(df)
    assert back.columns == df.columns
    expected = [t if not texts[d, t][0] else texts[d, t][1] for d, t in rows]
    assert sorted(map(str, [r.text for r in back.collect()])) == sorted(map(str, expected))


def test_stripped_takes_columns_of_any_name(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    names = ("_version", "_doc", "_v", "_starts", "starts", "version", "kept", "rest", "row")
    df = table(spark, [(1, passage), (2, f"own {passage} end"), (None, passage), (3, None)], *names)
    rows = {r.doc_id: r for r in s.stripped(df).collect()}
    assert rows[2].text == "own end" and rows[1].text == rows[None].text == passage and rows[3].text is None
    assert all(r[n] == "x" for r in rows.values() for n in names)


def test_empty_table(spark):
    assert s.without_repeats(table(spark, [])).collect() == []


def test_sketch_never_counts_too_low(spark):
    rows = corpus()
    bits, cells = s.repeated_cells(table(spark, rows).select("text"))
    seen = {}
    for n, (_, text) in enumerate(rows):
        keys = s._keys(s.word_hashes(s.encoded(text, False))) if len(words(text)) >= 50 else []
        for k in np.asarray(keys, np.uint64).tolist():
            seen.setdefault(k, set()).add(n)
    repeated = np.asarray([k for k, v in seen.items() if len(v) > 1], np.uint64)
    for row in range(s.ROWS):
        at = row * cells + s._cells(repeated, row, cells)
        assert np.unpackbits(bits)[at].all()
    assert s.sketch_cells(10**18) == s.MAX_CELLS
