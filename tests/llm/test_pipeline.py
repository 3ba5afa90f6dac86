"""The stages one after another, each against the one before."""

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import prose, words
from tests.llm.test_jaccard_join import plain as groups
from tests.llm.test_substrings import plain as repeats

import __spark_entry__ as contract


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, small))
        out[name] = docs
        if name != "byte_pairs":
            assert docs.columns == columns
    start = texts(spark.read.parquet(f"{small}/documents.parquet"))
    mild = texts(out["toxicity"])
    assert mild.items() <= start.items() and len(mild) > len(start) / 2
    single = texts(out["jaccard_join"])
    assert single == {d: t for d, t in mild.items() if groups(mild)[d][1] == d}
    bare = texts(out["substring_dedup"])
    rows = sorted(single.items())
    expected = {d: t if not gone else kept for (d, t), (_, _, gone, kept) in zip(rows, repeats(rows))}
    assert bare == expected
    assert all(r.n_chars == len(r.text) for r in out["substring_dedup"].collect())
    clean = texts(out["decontamination"])
    assert clean.items() <= bare.items()
    items = [" ".join(words(r.text)).lower() for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    held = {d for d, t in bare.items() for i in items if f" {i} " in f" {' '.join(words(t)).lower()} "}
    assert not held & clean.keys() and len(bare) - len(clean) < len(held) + 5
    ends = {r.doc_id: r.decoded_sha256 for r in out["byte_pairs"].collect()}
    assert ends == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in clean.items()}
    assert ends.keys() == {r.doc_id for r in corpus_pipeline.run(spark, small).collect()}


def odd_docs(spark, rows, *names):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({n: F.lit("x") for n in ("row_id", "component_id", "starts", *names)}).repartition(3)


def test_rows_that_share_an_id_or_have_none(spark, small):
    copy = " ".join(prose(random.Random(4), 80))
    item, other = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").orderBy("item_id").take(2)]
    rows = [(d, t, "en", "s", len(t or "")) for d, t in (
        (1, copy), (1, copy), (None, copy), (None, copy), (2, "clean words of its own here"), (3, f"so {item} end"),
        (3, "the other text of three is clean"), (None, other), (4, None), (5, ""), (6, "short"))]
    docs = odd_docs(spark, rows)
    single = corpus_pipeline.drop_near_copies(spark, docs, small)
    assert single.columns == docs.columns
    left = Counter((r.doc_id, r.text) for r in single.collect())
    assert left == Counter({(d, t) for d, t, *_ in rows if t != copy} | {(1, copy)})
    bare = corpus_pipeline.drop_repeats(spark, single, small)
    assert bare.columns == docs.columns and bare.count() == single.count()
    clean = Counter((r.doc_id, r.text) for r in corpus_pipeline.drop_leaks(spark, single, small).collect())
    assert clean == left - Counter({(3, f"so {item} end"): 1, (None, other): 1})
    mild = corpus_pipeline.drop_toxic(spark, odd_docs(spark, rows), small)
    assert mild.columns == docs.columns
    ends = corpus_pipeline.encode(spark, docs, small).collect()
    assert len(ends) == len(rows)


def test_repeated_rows_lose_passages_to_each_other(spark, small):
    passage = " ".join(prose(random.Random(6), 60))
    docs = odd_docs(spark, [(d, f"{own} {passage}", "en", "s", 9) for d, own in ((7, "a"), (7, "b"), (None, "c"))])
    kept = Counter(len(words(r.text)) for r in corpus_pipeline.drop_repeats(spark, docs, small).collect())
    assert kept == {61: 1, 1: 2}


def test_empty_table(spark, small):
    docs = odd_docs(spark, [])
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, small).collect() == [], name


def test_registered():
    names = contract.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(bool(re.match(rf"op{n}_", name)) for name in names) == 1
