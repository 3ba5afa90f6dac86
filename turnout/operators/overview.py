"""All scalar checks of a raw table from one scan, alone or while the table is written."""

from pyspark.sql import Column, DataFrame, Observation, functions as F

from turnout.functions import (
    elapsed_seconds,
    incident_ts,
    is_blank,
    is_stamp_text,
    is_time_text,
    parse_date,
    parse_ts,
)
from turnout.operators.quality import REQUIRED_COLUMNS
from turnout.schema import BOROUGHS, DATE_COLUMNS, RAW_COLUMNS, STAMP_COLUMNS

_READ = "_read"


def _with_readings(df: DataFrame) -> DataFrame:
    """The rows with what several checks need to read from text, read once for each row."""
    readings = F.struct(
        incident_ts("INCIDENT_DATE", "INCIDENT_TIME").alias("incident"),
        *[parse_ts(c).alias(c) for c in ("ADD_TS", "DISP_TS", "CLOSNG_TS")],
        *[parse_date(c).alias(c) for c in DATE_COLUMNS],
        *[is_stamp_text(c).alias(f"{c}_ok") for c in STAMP_COLUMNS],
    )
    return df.select("*", F.inline(F.array(F.struct(readings.alias(_READ)))))


def scalar_checks(
    columns=RAW_COLUMNS, boroughs=BOROUGHS, tolerance: int = 60, required=None, length_of: str = "TYP_DESC",
) -> dict[tuple[str, str], Column]:
    """Aggregates over ``_with_readings`` by check and by the column that is checked."""
    def read(name: str) -> Column:
        return F.col(f"{_READ}.{name}")

    if required is None:
        required = [c for c in REQUIRED_COLUMNS if c in columns]
    late = elapsed_seconds(read("ADD_TS"), read("incident"))
    checks = {
        ("rows", "*"): F.count(F.lit(1)),
        ("max_length", length_of): F.max(F.length(length_of)),
        (f"late_by_{tolerance}", "INCIDENT_TIME"): F.count_if(late > tolerance),
        ("late_by_0", "INCIDENT_TIME"): F.count_if(late > 0),
        ("invalid", "INCIDENT_TIME"): F.count_if(~is_time_text(F.trim("INCIDENT_TIME"))),
        ("invalid_untrimmed", "INCIDENT_TIME"): F.count_if(~is_time_text("INCIDENT_TIME")),
        ("before_ADD_TS", "DISP_TS"): F.count_if(read("DISP_TS") < read("ADD_TS")),
        ("outside_domain", "BORO_NM"): F.count_if(~F.col("BORO_NM").isin(*boroughs)),
        ("before_CREATE_DATE", "INCIDENT_DATE"): F.count_if(read("INCIDENT_DATE") < read("CREATE_DATE")),
        ("after_CLOSNG_TS", "INCIDENT_DATE"): F.count_if(
            read("INCIDENT_DATE").cast("timestamp_ntz") > read("CLOSNG_TS")),
    }
    for c in columns:
        checks["null", c] = F.count_if(F.col(c).isNull())
        checks["null_or_blank", c] = F.count_if(is_blank(c))
    for c in DATE_COLUMNS:
        checks["earliest", c], checks["latest", c] = F.min(read(c)), F.max(read(c))
    for c in STAMP_COLUMNS:
        checks["invalid", c] = F.count_if(~read(f"{c}_ok"))
    for c in required:
        present = read(f"{c}_ok") if c in STAMP_COLUMNS else F.col(c).isNotNull()
        checks["missing", c] = F.count_if(~F.coalesce(present, F.lit(False)))
    return checks


def profile_raw(df: DataFrame, boroughs=BOROUGHS, tolerance: int = 60) -> DataFrame:
    """A row for each scalar check: ``check_name``, ``column_name``, ``value`` as text; one scan, one aggregate.

    Checks that list rows or count distinct values are not scalar: see ``quality`` and ``sketches``.
    """
    checks = scalar_checks(df.columns, boroughs, tolerance)
    names = [f"_{i}" for i in range(len(checks))]
    totals = _with_readings(df).agg(*[c.alias(name) for c, name in zip(checks.values(), names)])
    lines = F.array(*[
        F.struct(F.lit(check).alias("check_name"), F.lit(column).alias("column_name"),
                 F.col(name).cast("string").alias("value"))
        for (check, column), name in zip(checks, names)
    ])
    return totals.select(F.inline(lines))


def profiled(df: DataFrame, seen: Observation, boroughs=BOROUGHS, tolerance: int = 60) -> DataFrame:
    """The same rows; the job that first passes over them also fills ``seen`` with every scalar check.

    Names in ``seen`` are ``check column``.
    """
    checks = scalar_checks(df.columns, boroughs, tolerance)
    named = [c.alias(f"{check} {column}") for (check, column), c in checks.items()]
    return _with_readings(df).observe(seen, *named).select(*df.columns)
