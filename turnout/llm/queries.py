"""The operators over the supplied tables, with production parameters."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from turnout.llm import (
    byte_pairs,
    decontaminate,
    fingerprints,
    jaccard_join,
    lexical,
    packing,
    quality,
    sql,
    substrings,
    token_blocks,
    token_counts,
    toxicity,
    trie,
    wrappers,
)
from turnout.llm.tables import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(_table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(_table(spark, sf_dir, "documents"), digest=True)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.token_blocks(_table(spark, sf_dir, "documents"), with_ids=False)


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(_table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op10_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_pairs.byte_pairs(_table(spark, sf_dir, "documents"), digest=True)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(_table(spark, sf_dir, "conversations"), regrow=True)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing(_table(spark, sf_dir, "documents"))


def build() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return query(spark, sf_dir)

        return run

    return {name: shipped(f) for name, f in globals().items() if name.startswith("op")}


def statements() -> dict[str, str]:
    """The other operators need a tokenizer, a model, a hash or a parser that SQL lacks."""
    return {
        "op1_jaccard_join": sql.JACCARD_JOIN,
        "op3_substring_dedup": sql.SUBSTRING_DEDUP,
        "op11_lexical_search": sql.LEXICAL_SEARCH,
        "op12_prefix_trie": sql.PREFIX_TRIE,
    }
