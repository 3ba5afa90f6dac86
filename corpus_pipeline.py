"""Stages that turn the documents into training text.

Every stage but the last returns the columns of ``documents``; each works on all that the one
before it kept.  Each row is a document of its own: rows that share an id, or have none, are judged one by
one, and of rows that repeat each other one stays.  A null or empty text is like no other, holds no
passage and is not toxic by itself; it passes all stages.  Texts of any length are read whole, an empty table
gives an empty one, and columns beside the known ones are carried along under any name.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from turnout.llm import byte_pairs, decontaminate, jaccard_join, substrings, toxicity
from turnout.llm.tables import checked_broadcast, ship_package, stored, with_row_ids


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the classifier does not call toxic; it learns from ``labels``.

    Empty texts have the score of an empty text.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels)
    return docs.where(toxicity.scores(docs, model) < toxicity.THRESHOLD)


def _without(docs: DataFrame, keyed: DataFrame, row_id: str, gone: DataFrame) -> DataFrame:
    """The columns of ``docs`` for the rows of ``keyed`` whose id is not in the stored table ``gone``."""
    gone = gone.select(F.col(gone.columns[0]).alias(row_id))
    return keyed.join(checked_broadcast(gone), row_id, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar ones, that with the lowest id; rows without an id come after all others."""
    keyed, row_id = with_row_ids(docs)
    groups = jaccard_join.similar_groups(keyed, row_id)
    return _without(docs, keyed, row_id, stored(groups.where("doc_id <> component_id").select("doc_id")))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without passages that an earlier one has; ``n_chars`` follows the text."""
    keyed, row_id = with_row_ids(docs)
    kept = substrings.stripped(keyed, row_id).select(*[F.col(f"`{c}`") for c in docs.columns])
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no item of ``benchmark``."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed, row_id = with_row_ids(docs)
    found = stored(decontaminate.leaks(keyed, benchmark, row_id).select("doc_id").distinct())
    return _without(docs, keyed, row_id, found)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and what they decode to, as digests beside the text's size, for each row."""
    return byte_pairs.byte_pairs(docs, digest=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("decontamination", drop_leaks),
    ("byte_pairs", encode),
]

#: The first stage is a trained classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; the last one's rows."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
