"""Deduplication, row filters and typing of the call table."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from turnout.functions import elapsed_seconds, format_hms, null_count, parse_date, parse_ts
from turnout.schema import (
    DATE_COLUMNS,
    DURATIONS,
    KEY,
    NON_CRITICAL,
    NULL_TEXT,
    SEVERITIES,
    STAMP_COLUMNS,
)

# --- deduplication --------------------------------------------------------

#: Rows that one task sorts where the number of rows is known.
TASK_ROWS = 1_000_000


def dedup_most_complete(
    df: DataFrame, key: str = KEY, null_keys: str = "collapse", n_rows: int | None = None
) -> DataFrame:
    """One row per key: the one with the fewest nulls.

    Ties go to the lowest row in column order, nulls last.  Rows without a key
    fall together into one row (``collapse``) or all stay (``keep``).

    ``row_number() == 1`` makes Spark put a group limit in front of the shuffle
    too, so a key with very many copies sends one row per map task.  That sort takes place in the task that
    makes the rows, beside the sorts of its joins.  With ``n_rows``, about how many rows there are, more than
    ``TASK_ROWS`` are first dealt to as many tasks as that takes, copies of a key too, and one row of each key
    and task is dealt again by the key.
    """
    if null_keys not in ("collapse", "keep"):
        raise ValueError(f"null_keys must be 'collapse' or 'keep', not {null_keys!r}")
    part, rows = [key], df
    if null_keys == "keep":
        # Rows without a key get numbers of their own as keys, so that one pass serves all.
        part.append("_own")
        rows = df.withColumn("_own", F.when(F.col(key).isNull(), F.monotonically_increasing_id()))
    order = (null_count(df.columns), *[F.asc_nulls_last(c) for c in df.columns if c != key])

    def first(rows, *part):
        window = Window.partitionBy(*part).orderBy(*order)
        return rows.withColumn("_row", F.row_number().over(window)).where(F.col("_row") == 1).drop("_row")

    tasks = -(-(n_rows or 0) // TASK_ROWS)
    if tasks > 1:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(tasks))
        rows = first(rows.withColumn("_salt", salt).repartition(tasks, *part, "_salt"), *part, "_salt")
        rows = rows.drop("_salt").repartition(tasks, *part)
    return first(rows, *part).drop("_own")


# --- typing ---------------------------------------------------------------

def typed(df: DataFrame, stamps=STAMP_COLUMNS) -> DataFrame:
    """Dates, precinct number and timestamps from text; bad text becomes null."""
    return df.withColumns({
        **{c: parse_date(c) for c in DATE_COLUMNS},
        "NYPD_PCT_CD": F.col("NYPD_PCT_CD").try_cast("int"),
        **{c: parse_ts(c) for c in stamps},
    })


def with_durations(df: DataFrame, wrap24: bool = False) -> DataFrame:
    """Response, dispatch and travel time, as exact seconds and as text."""
    return df.withColumns({
        f"{name}_SEC": elapsed_seconds(start, end) for name, (start, end) in DURATIONS.items()
    }).withColumns({name: format_hms(f"{name}_SEC", wrap24) for name in DURATIONS})


# --- predicates -----------------------------------------------------------

def valid_borough(column: str = "BORO_NM") -> Column:
    """Not null and not the text ``(null)``; the text test is case-sensitive."""
    return F.col(column).isNotNull() & (F.trim(column) != NULL_TEXT)


def dispatched_in_order(dispatched: str = "DISP_TS", added: str = "ADD_TS") -> Column:
    """Dispatch not before the call; unknown times pass."""
    return F.coalesce(F.col(dispatched) >= F.col(added), F.lit(True))


def incident_within(
    tolerance: int = 60, incident: str = "INCIDENT_TS", added: str = "ADD_TS"
) -> Column:
    """Incident at most ``tolerance`` seconds after the call; unknown times pass."""
    return F.coalesce(elapsed_seconds(added, incident) <= tolerance, F.lit(True))


def severity_in_scope(column: str = "CIP_JOBS", values=SEVERITIES) -> Column:
    """One of the three severities, whatever the case or the blanks around it."""
    return F.upper(F.trim(column)).isin(*values)


def responded_after(seconds: int = 90, column: str = "RESPONSE_TIME_SEC") -> Column:
    return F.col(column) > seconds


def positive(metric: str = "RESPONSE_TIME_SEC") -> Column:
    """Known and above zero."""
    return F.col(metric).isNotNull() & (F.col(metric) > 0)


def non_critical(column: str = "CIP_JOBS") -> Column:
    return F.col(column) == NON_CRITICAL


def high_severity(column: str = "CIP_JOBS", values=None) -> Column:
    """Any known severity but non-critical, or one of ``values`` where given."""
    if values is not None:
        return F.col(column).isin(*values)
    return F.col(column) != NON_CRITICAL
