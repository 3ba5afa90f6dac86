"""The seven marts, and the whole run from raw text to marts."""

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from turnout.operators.cleaning import dedup_most_complete
from turnout.operators.encoding import category_codes
from turnout.operators.ledger import ROWS_IN, ROWS_OUT, ledger_table, observed_rows
from turnout.operators.profiles import (
    borough_detail,
    borough_profile,
    hourly_profile,
    precinct_profile,
    response_counts,
    severity_profile,
)
from turnout.operators.ranking import precinct_ranked
from turnout.plans.stages import clean_typed, normalize, scope, type_calls
from turnout.sources import (
    read_current,
    read_marts,
    read_stage,
    replace_stage,
    write_marts,
    write_stage,
)

# Output paths, which later readers of the marts expect.
MART_NAMES = (
    "Part1/dfBoroughStats",
    "Part1/dfBoroughResponse",
    "Part1/dfPrecinctStats",
    "Part1/dfPrecinctResponseRanked",
    "Part2/dfCIPStats",
    "Part3/dfHourlyStatsNonCritical",
    "Part3/dfHourlyStatsHighSeverity",
)


def build_marts(
    calls: DataFrame, accuracy: int | None = None, counts: DataFrame | None = None, k: int = 5
) -> dict[str, DataFrame]:
    """The marts of a normalized table, by name; each carries seconds and text.

    With ``counts``, the stored ``response_counts`` of the same table, the first four come from these.
    """
    built = (
        borough_profile(calls, accuracy, counts),
        borough_detail(calls, accuracy=accuracy, counts=counts),
        precinct_profile(calls, accuracy, counts),
        precinct_ranked(calls, k, accuracy=accuracy, counts=counts),
        severity_profile(calls, accuracy),
        hourly_profile(calls, "non_critical"),
        hourly_profile(calls, "high_severity"),
    )
    return dict(zip(MART_NAMES, built))


def run_stages(
    spark: SparkSession, raw: DataFrame, root: str, files: int | None = None,
    null_keys: str = "collapse", tolerance: int = 60, min_response: int = 90,
    wrap24: bool = False, accuracy: int | None = None, k: int = 5, row_stages: bool = True,
    versions: bool = False,
) -> dict[str, DataFrame]:
    """Run everything, writing each stage below ``root``, and return the stored marts.

    Each stage is read back from its files, so a lost executor costs at most
    part of one stage.  The typed table is stored before it is filtered: the
    text is then parsed once, though both the code table and the filters read
    it.  The code table is stored because its file size tells Spark whether to
    broadcast it, so that the calls need not be shuffled for it.

    ``row_stages=False`` leaves out the files of the scoped and the normalized table, which
    only filter and rewrite rows of the cleaned one.  Exact medians come from one stored table of counts.

    With ``versions`` every stage and mart becomes a new version of itself, and a run that fails leaves the ones
    before as they were; else a folder of the same name is overwritten.  ``ledger`` is stored last: what deduplication and each filter dropped, counted while the stages were written.
    """
    def stored(name: str, df: DataFrame, files: int | None = files) -> DataFrame:
        if versions:
            replace_stage(df, f"{root}/{name}", files)
            return read_current(spark, f"{root}/{name}")
        write_stage(df, f"{root}/{name}", files)
        return read_stage(spark, f"{root}/{name}")

    read, kept, cleaning, scoping = (Observation() for _ in range(4))
    rows = F.count(F.lit(1)).alias("rows")
    deduped = dedup_most_complete(raw.observe(read, rows), null_keys=null_keys).observe(kept, rows)
    typed = stored("typed", type_calls(deduped, wrap24), None)
    codes = stored("type_codes", category_codes(typed, "TYP_DESC"), None)
    cleaned = stored("cleaned", clean_typed(typed, codes, tolerance, cleaning))
    scoped = scope(cleaned, min_response, scoping)
    if row_stages:
        scoped = stored("scoped", scoped)
    normalized = normalize(scoped)
    if row_stages:
        normalized = stored("normalized", normalized)
    counts = stored("response_counts", response_counts(normalized), None) if accuracy is None else None
    n_read, n_kept = read.get["rows"], kept.get["rows"]
    dropped = [("dedup", 0, ROWS_IN, n_read), ("dedup", 1, "most_complete", n_read - n_kept), ("dedup", 2, ROWS_OUT, n_kept)]
    write_marts(build_marts(normalized, accuracy, counts, k), f"{root}/marts", versions)
    dropped += [*observed_rows("clean", cleaning), *observed_rows("scope", scoping)]
    stored("ledger", ledger_table(spark, dropped), 1)
    return read_marts(spark, f"{root}/marts", MART_NAMES, versions)
