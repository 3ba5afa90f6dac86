"""Fingerprints: neighbours and edited texts exactly, likeness against true similarity."""

import hashlib
import re
from collections import Counter

import numpy as np

from tests.llm.helpers import corpus, table
from turnout.llm import fingerprints as f


def bag(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text.lower()) if x]
    return Counter(zip(w, [*w[1:], ""]))


def similarity(a, b):
    a, b = bag(a), bag(b)
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def expected(rows):
    """In ascending order of the id, none first, then of the text."""
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for i, (doc_id, text) in enumerate(order):
        following, half = order[(i + 1) % len(order)][1], len(text) // 2
        out.append((doc_id, text, text[: len(text) - half] + following[:half], following))
    return out


def check(spark, rows, monkeypatch, size):
    monkeypatch.setattr(f, "RANGE_BYTES", size)
    found = f.fingerprints(table(spark, rows, "part", "row", "guest", "next", "own")).collect()
    digest = [(d, len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e, _ in expected(rows)]
    assert sorted([tuple(r)[:3] for r in found], key=str) == sorted(digest, key=str)
    return found


def test_edited_texts_and_likeness(spark, monkeypatch):
    rows = corpus()
    found = check(spark, rows, monkeypatch, 2000)
    by_text = {}
    truth = {hashlib.sha256(e.encode()).hexdigest(): (similarity(t, e), similarity(t, n))
             for _, t, e, n in expected(rows) if t}
    errors = []
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.edited_sha256 in truth and r.n_chars > 200:
            errors.append(r.near_edited - truth[r.edited_sha256][0])
    assert abs(np.mean(errors)) < 0.05 and np.std(errors) < 0.15
    for d, t, _, _ in expected(rows):
        by_text.setdefault(t.lower(), set()).update(
            r.fingerprint for r in found if r.doc_id == d and r.n_chars == len(t))
    assert len(by_text[corpus()[0][1].lower()]) == 1
    empty = [r for r in found if r.doc_id in (801, 802, 803)]
    assert [r.fingerprint for r in empty] == ["", "", ""]


def test_one_range_and_few_rows(spark, monkeypatch):
    check(spark, corpus()[:5], monkeypatch, 1 << 22)
    (one,) = check(spark, [(7, "a b c d")], monkeypatch, 1 << 22)
    assert one.near_next == 1.0
    assert check(spark, [], monkeypatch, 1 << 22) == []


def test_draws_are_gamma_and_uniform(spark):
    rows = f.draws(spark).where("term < 2000").toPandas()
    r = np.stack(rows["r"])
    assert abs(r.mean() - 2) < 0.03 and abs(r.var() - 2) < 0.1
    b = np.stack(rows["b"])
    assert abs(b.mean() - 0.5) < 0.01 and abs(b.var() - 1 / 12) < 0.005


def test_collision_rate_is_the_weighted_similarity(spark, monkeypatch):
    texts = ["x " * 3 + "y " * 5 + "z " * 4, "x " * 6 + "y " * 2 + "w " * 4]
    monkeypatch.setattr(f, "SAMPLES", 256)
    rows = f.fingerprints(table(spark, list(enumerate(texts)))).collect()
    assert abs(rows[0].near_next - similarity(*texts)) < 0.1


def test_long_texts_by_the_number_of_samples_in_use(spark):
    # Unlike texts do not look alike however long they are, and a half-edited one does by a third.
    texts = [" ".join(f"{side}{i}" for i in range(40_000)) for side in "pq"]
    rows = f.fingerprints(table(spark, list(enumerate(texts)))).collect()
    for r in rows:
        assert len(r.fingerprint) == 8 * f.SAMPLES
        assert r.near_next < 0.05
        assert abs(r.near_edited - 1 / 3) < 3.5 * (2 / 9 / f.SAMPLES) ** 0.5


def test_a_term_that_occurs_once_needs_no_logarithm(spark):
    # Its order is a uniform number from the hash, which grows with the same draw's c y.
    rows = spark.range(2000).selectExpr("id as term").selectExpr(
        *[f"{x} as {name}" for x, name in zip(f._draw(3), ("bits", "e", "f", "s"), strict=True)]).toPandas()
    assert rows.bits.between(0, 2**31 - 1).all()
    assert (np.abs(-np.expm1(-rows.e) * 2**31 - rows.bits) <= 1).all()
    assert "ln(" not in f._draw(3)[0]
    for column in ("e", "f", "s"):
        assert abs(rows[column].mean() - 1) < 0.1
    assert np.abs(np.corrcoef(rows[["e", "f", "s"]].T) - np.eye(3)).max() < 0.1


def test_the_plan_has_each_formula_once(spark):
    # The driver plans and compiles every copy again; only the hash of a term that occurs once is there by draw.
    rows = f.fingerprints(table(spark, [(1, "a b a b c d"), (2, "a b c")]))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.lower().count("log1p") <= 8
    assert len(rows.collect()) == 2


def test_one_formula_for_all_draws(spark):
    terms = spark.range(500).selectExpr("id as term").crossJoin(spark.range(4).selectExpr("int(id) as k"))
    for k in range(4):
        one, all_ = f._draw(k), f._draw("k")
        assert terms.where(f"k = {k}").where(" or ".join(
            f"{x} <> {y}" for x, y in zip(one, all_, strict=True))).isEmpty()
