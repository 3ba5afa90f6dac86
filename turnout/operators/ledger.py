"""Row filters in order, and how many rows each of them drops.

A row is dropped by the first rule that it does not meet, so the numbers of the rules add up to the rows that
went in less those that came out.  ``apply_rules`` counts while the rows pass by, in the job that
writes them: no further scan.  What a task counted is added when it ends; if a lost executor
has part of a stage computed again, such counts may include rows twice.  ``rejects`` counts in a scan of its
own and is exact then too.
"""

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from turnout.operators.cleaning import (
    dispatched_in_order,
    incident_within,
    responded_after,
    severity_in_scope,
    valid_borough,
)

SCHEMA = "stage string, step int, rule string, num_rows bigint"
ROWS_IN, ROWS_OUT = "rows_in", "rows_out"


def clean_rules(tolerance: int = 60) -> dict[str, Column]:
    """The filters of stage 1."""
    return {
        "valid_borough": valid_borough(),
        "dispatched_in_order": dispatched_in_order(),
        "incident_within": incident_within(tolerance),
    }


def scope_rules(min_response: int = 90) -> dict[str, Column]:
    """The filters of stage 2."""
    return {"severity_in_scope": severity_in_scope(), "responded_after": responded_after(min_response)}


def _counts(rules: dict[str, Column]) -> Iterator[Column]:
    yield F.count(F.lit(1)).alias(ROWS_IN)
    passed = F.lit(True)
    for name, rule in rules.items():
        # A filter drops what it cannot decide.
        meets = F.coalesce(rule, F.lit(False))
        yield F.count_if(passed & ~meets).alias(name)
        passed = passed & meets
    yield F.count_if(passed).alias(ROWS_OUT)


def apply_rules(df: DataFrame, rules: dict[str, Column], seen: Observation | None = None) -> DataFrame:
    """The rows that meet all rules; ``seen`` gets the counts once the first job over them ends."""
    if seen is not None:
        df = df.observe(seen, *_counts(rules))
    for rule in rules.values():
        df = df.where(rule)
    return df


def rejects(df: DataFrame, rules: dict[str, Column], stage: str) -> DataFrame:
    """The same counts from one scan: ``stage``, ``step``, ``rule`` and ``num_rows``."""
    names = [ROWS_IN, *rules, ROWS_OUT]
    lines = F.array(*[
        F.struct(F.lit(stage).alias("stage"), F.lit(i).alias("step"), F.lit(name).alias("rule"),
                 F.col(name).alias("num_rows"))
        for i, name in enumerate(names)
    ])
    return df.agg(*_counts(rules)).select(F.inline(lines))


def observed_rows(stage: str, seen: Observation) -> list[tuple]:
    """Rows of the ledger from what an observation saw; waits for its job."""
    return [(stage, i, name, n) for i, (name, n) in enumerate(seen.get.items())]


def ledger_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """The ledger of a run, a few rows for each stage, as a table."""
    return spark.createDataFrame(rows, SCHEMA)
