"""Toxicity and quality: held-out results, defined odd cases, and the parts by themselves."""

import zlib

import numpy as np

from tests.llm.helpers import SCHEMA, table
from turnout.llm import quality as q, toxicity as t


def read(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def auc(scores, labels):
    scores, labels = np.asarray(scores), np.asarray(labels)
    good, bad = scores[labels == 1], scores[labels == 0]
    return np.mean([(good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2])


def test_toxicity_of_the_held_out_fold(spark):
    folder = "/root/testdata/sf0.01"
    rows = t.toxicity(read(spark, folder, "documents"), read(spark, folder, "labels")).collect()
    assert len(rows) == 1000
    labels = {r.doc_id: r.toxic for r in read(spark, folder, "labels").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert auc([r.score for r in held], [labels[r.doc_id] for r in held]) > 0.75
    caught = [r for r in held if labels[r.doc_id] == 1]
    assert sum(r.predicted for r in caught) > len(caught) / 2


def labelled():
    """Texts of which the toxic ones have a word of their own."""
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(600):
        words = [f"w{n}" for n in rng.integers(0, 200, 40)]
        toxic = i % 10 == 0
        if toxic:
            words[7] = "dreadful"
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


ODD = [(1000, None), (1001, ""), (1002, " \n"), (None, "w1 w2 dreadful"), (5, "w3"), (5, "w3"), (1003, "w1 " * 50_000)]


def test_toxicity_of_odd_rows(spark):
    rows, labels = labelled()
    marks = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    found = t.toxicity(table(spark, rows + ODD, "score", "positive", "bins"), marks).collect()
    assert len(found) == len(rows) + len(ODD)
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert all(r.predicted == int(r.doc_id % 10 == 0) for r in held if r.doc_id != 5)
    blank = {r.score for r in found if r.doc_id in (1000, 1001, 1002)}
    assert len(blank) == 1 and blank.pop() < 0.3
    assert [r.predicted for r in found if r.doc_id is None] == [1]
    assert len({r.score for r in found if r.doc_id == 5 and r.score is not None}) <= 2


def test_held_out_labels_are_not_learnt(spark):
    rows, labels = labelled()
    docs = table(spark, rows)
    turned = [(d, y if zlib.crc32(str(d).encode()) % 4 != 2 else 1 - y) for d, y in labels]
    a, b = (
        {r.doc_id: r.score for r in t.toxicity(docs, spark.createDataFrame(x, "doc_id long, toxic int")).collect()}
        for x in (labels, turned)
    )
    assert a == b


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    found = t.toxicity(table(spark, [(1, "a b"), (2, None)]), none).collect()
    assert [r.predicted for r in found] == [0, 0] and max(r.score for r in found) < 1e-6
    assert t.toxicity(table(spark, []), none).collect() == []


def test_risk_does_not_fall_below_zero():
    rng = np.random.default_rng(2)
    positive = [np.asarray([1, 2], np.int32)] * 30
    unlabelled = [rng.integers(3, 50, 5).astype(np.int32) for _ in range(300)] + positive[:10]
    model = t.fit(positive, unlabelled, 0.05, 64)
    assert model.score(positive[0]) > 0.5
    assert np.mean([model.score(u) for u in unlabelled[:300]]) < 0.2


def test_quality_of_the_held_out_fold(spark):
    folder = "/root/testdata/sf0.01"
    rows = q.quality(read(spark, folder, "documents"), read(spark, folder, "labels")).collect()
    assert len(rows) == 1000
    labels = {r.doc_id: r.quality for r in read(spark, folder, "labels").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert auc([r.score for r in held], [labels[r.doc_id] for r in held]) > 0.8
    assert sum(r.keep for r in rows) > 500


def test_sparse_sites_shrink_toward_the_level_above(spark):
    rows = [(f"h{i % 2}", f"p{i % 4}", 1.0, float(i % 2)) for i in range(400)]
    rows += [("h0", "new", 1.0, 1.0), ("lone", "p", 1.0, 0.0), (None, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "host string, path string, n double, good double")
    found, share = q.site_posteriors(df)
    p = {(r.host, r.path): r.posterior for r in found.collect()}
    assert p["h0", "p0"] < 0.1 and p["h1", "p1"] > 0.9
    assert p["h0", "p0"] < p["h0", "new"] < share  # one good document in a bad host
    assert p["h0", "p0"] < p["lone", "p"] < share < p[None, None] < p["h1", "p1"]
    assert abs(share - (200 + 2) / 403) < 1e-9


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "a", "x"), (2, "", None, None), (2, "b c", "a", None), (None, "d", "a", "x")],
        SCHEMA + ", source string, lang string")
    marks = spark.createDataFrame([(1, 1), (None, 0)], "doc_id long, quality int")
    found = q.quality(docs, marks).collect()
    assert len(found) == 4 and all(0 < r.score < 1 for r in found)
    assert q.quality(docs.limit(0), marks).collect() == []
    assert all(abs(r.document_score - 0.5) < 1e-6 for r in q.quality(docs, marks.limit(0)).collect())


def test_training_rows_lie_in_one_piece(spark, small, monkeypatch):
    fitted = []
    monkeypatch.setattr(t, "fit", lambda positive, unlabelled, prior: fitted.append((positive, unlabelled)))
    t.train(read(spark, small, "documents"), read(spark, small, "labels"))
    ((positive, unlabelled),) = fitted
    assert positive and unlabelled and len({id(x.base) for x in positive + unlabelled}) == 1
    counts = t._counts(unlabelled, t.BINS)
    assert (counts == np.bincount(np.concatenate(unlabelled), minlength=t.BINS)).all()
