"""Profiling and data-quality checks on the raw, all-text table.

Each check is one lazy DataFrame; none runs an action.  Checks over many
columns fold them into one pass instead of rescanning the text per column.
"""

from pyspark.sql import Column, DataFrame, functions as F

from turnout.functions import (
    elapsed_seconds,
    incident_ts,
    is_blank,
    is_stamp_text,
    is_time_text,
    parse_date,
    parse_ts,
)
from turnout.operators.numbering import ranks_in_slices
from turnout.schema import BOROUGHS, DATE_COLUMNS, KEY, RAW_COLUMNS, STAMP_COLUMNS

# Columns looked at, and the words of the status columns below.
STATUS_COLUMNS = ("INCIDENT_TIME", *STAMP_COLUMNS)
REQUIRED_COLUMNS = (
    "CAD_EVNT_ID", "ARRIVD_TS", "CLOSNG_TS", "PATRL_BORO_NM", "RADIO_CODE", "TYP_DESC",
)


# --- counts and distinct values -------------------------------------------

def row_count(df: DataFrame) -> DataFrame:
    """Number of rows, counted and summed: the two must agree."""
    return df.agg(
        F.count("*").alias("num_rows"),
        F.coalesce(F.sum(F.lit(1)), F.lit(0)).cast("bigint").alias("num_rows_summed"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column; null counts as a value."""
    return df.select(column).distinct()


def distinct_counts(df: DataFrame, columns=RAW_COLUMNS) -> DataFrame:
    """Number of distinct values of each column, null counted as one value.

    One scan: cells shuffle as distinct (column, value) pairs, reduced before
    the shuffle as well, so a frequent value costs one pair per task and no
    column lands whole in one task.
    """
    cells = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    return cells.distinct().groupBy("column_name").agg(F.count("*").alias("num_distinct"))


def distinct_pair_count(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(a, b).distinct().agg(F.count("*").alias("num_pairs"))


# --- does a key determine a value? ----------------------------------------

def _value_counts(pairs: DataFrame, key: str, value: str, count_name: str) -> DataFrame:
    return pairs.groupBy(F.col(key).alias("_key")).agg(F.count(value).alias(count_name))


def dependency_map_pairs(
    df: DataFrame, key: str, value: str, count_name: str = "num_values"
) -> DataFrame:
    """Each key with each of its non-null values and the number of them; a key without any has one null.

    Distinct pairs come first: they shuffle on key and value together, so a key
    that holds much of the table is reduced before its values are counted, and
    nothing gathers them.
    """
    pairs = df.select(key, value).distinct()
    counts = _value_counts(pairs, key, value, count_name)
    return (
        pairs.join(counts, F.col(key).eqNullSafe(F.col("_key")))
        .where(F.col(value).isNotNull() | (F.col(count_name) == 0))
        .select(key, value, count_name)
    )


def dependency_pairs(
    df: DataFrame, key: str, value: str, count_name: str = "num_values"
) -> DataFrame:
    """The violations, keys with more than one non-null value, with one row per key and value."""
    pairs = df.select(key, value).distinct()
    broken = _value_counts(pairs, key, value, count_name).where(F.col(count_name) > 1)
    return (
        pairs.where(F.col(value).isNotNull())
        .join(broken, F.col(key).eqNullSafe(F.col("_key")))
        .select(key, value, count_name)
    )


def violation_counts(
    df: DataFrame, key: str, value: str, count_name: str = "num_values"
) -> DataFrame:
    """Keys with more than one non-null value and the number of them, most first; no sets."""
    return (
        _value_counts(df.select(key, value).distinct(), key, value, count_name)
        .where(F.col(count_name) > 1)
        .select(F.col("_key").alias(key), count_name)
        .orderBy(F.desc(count_name), F.asc_nulls_last(key))
    )


#: Values in one cell.
CELL = 1000


def _cells(
    pairs: DataFrame, key: str, value: str, set_name: str, count_name: str, size: int
) -> DataFrame:
    """``key``, ``chunk``, the sorted values of the chunk, at most ``size``, and the number of all values of the key.

    The values of a key with more of them are numbered in the order of their hashes, in slices, and
    cut into chunks by number: no task and no cell ever holds all of them.
    """
    few = pairs.where(F.col(count_name) <= size).withColumn("chunk", F.lit(0).cast("bigint"))
    hashed = pairs.where(F.col(count_name) > size).withColumn("_hash", F.xxhash64(value))
    many = ranks_in_slices(hashed, [key], "_hash", [value]).withColumn(
        "chunk", F.floor((F.col("RANK_FAST") - 1) / size))
    columns = [key, value, count_name, "chunk"]
    return few.select(columns).unionByName(many.select(columns)).groupBy(key, count_name, "chunk").agg(
        F.sort_array(F.collect_list(value)).alias(set_name)
    ).select(key, "chunk", set_name, count_name)


def dependency_cells(
    df: DataFrame, key: str, value: str, set_name: str = "values", count_name: str = "num_values",
    size: int = CELL, only_violations: bool = False,
) -> DataFrame:
    """Each key with its non-null values in cells of at most ``size``: ``key``, ``chunk``, values, their number.

    A key without any value has one empty cell, unless only violations are asked for.
    """
    pairs = (dependency_pairs if only_violations else dependency_map_pairs)(df, key, value, count_name)
    return _cells(pairs, key, value, set_name, count_name, size)


def dependency_map(
    df: DataFrame, key: str, value: str, set_name: str = "values", count_name: str = "num_values",
    size: int = CELL,
) -> DataFrame:
    """Each key with the sorted set of its non-null values; a key with more than ``size`` has several such rows.

    ``dependency_map_pairs`` has a row for each value, ``dependency_cells`` the number of each cell.
    """
    return dependency_cells(df, key, value, set_name, count_name, size).drop("chunk")


def dependency_violations(
    df: DataFrame, key: str, value: str, set_name: str = "values", count_name: str = "num_values",
    size: int = CELL,
) -> DataFrame:
    """Keys with more than one non-null value and the set of them, most values first.

    The keys are found by counts; only their sets are gathered, in rows of at most ``size`` values.
    """
    cells = dependency_cells(df, key, value, set_name, count_name, size, only_violations=True)
    return cells.orderBy(F.desc(count_name), F.asc_nulls_last(key), "chunk").drop("chunk")


def missing_values(df: DataFrame, column: str, show) -> DataFrame:
    """Distinct ``show`` columns of the rows where a text is null or blank."""
    return df.where(is_blank(column)).select(*show).distinct()


def duplicate_keys(df: DataFrame, key: str = KEY) -> DataFrame:
    """Keys that occur more than once, with how often; null is a key too."""
    return df.groupBy(key).agg(F.count("*").alias("num_rows")).where(F.col("num_rows") > 1)


# --- ranges ---------------------------------------------------------------

def max_length(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(F.length(column)).alias(f"max_{column}_len"))


def date_range(df: DataFrame, columns=DATE_COLUMNS) -> DataFrame:
    """Earliest and latest of each date column of text."""
    return df.agg(*[
        bound(parse_date(c)).alias(f"{name}_{c}")
        for c in columns
        for name, bound in (("min", F.min), ("max", F.max))
    ])


# --- times ----------------------------------------------------------------

def late_incidents(df: DataFrame, tolerance: int = 60) -> DataFrame:
    """Rows whose incident lies more than ``tolerance`` seconds after the call."""
    # A filter does not move below ``inline``, so each text is parsed once per row.
    parsed = F.struct(
        incident_ts("INCIDENT_DATE", "INCIDENT_TIME").alias("INCIDENT_TS_FORMATTED"),
        parse_ts("ADD_TS").alias("ADD_TS_FORMATTED"),
    )
    return df.select("*", F.inline(F.array(parsed))).where(
        elapsed_seconds("ADD_TS_FORMATTED", "INCIDENT_TS_FORMATTED") > tolerance
    )


def _parse_status(column: str) -> Column:
    return (
        F.when(F.col(column).isNull(), "missing")
        .when(~is_stamp_text(column), "invalid")
        .otherwise("ok")
    )


def time_status(df: DataFrame, key: str = KEY, stamps=STAMP_COLUMNS) -> DataFrame:
    """``missing``, ``invalid`` or ``ok`` for the time text and each timestamp text."""
    time = (
        F.when(F.col("INCIDENT_TIME").isNull(), "missing")
        .when(~is_time_text(F.trim("INCIDENT_TIME")), "invalid")
        .otherwise("ok")
    )
    return df.select(
        key,
        time.alias("INCIDENT_TIME_status"),
        *[_parse_status(c).alias(f"{c}_status") for c in stamps],
    )


def status_counts(df: DataFrame, columns=STATUS_COLUMNS) -> DataFrame:
    """Number of invalid entries per column of ``time_status``, in one pass."""
    names = [f"{c}_status" for c in columns]
    totals = time_status(df).agg(*[F.count_if(F.col(n) == "invalid").alias(n) for n in names])
    return totals.unpivot([], names, "column_name", "num_invalid")


def order_violations(df: DataFrame, later: str = "DISP_TS", earlier: str = "ADD_TS") -> DataFrame:
    """Number of rows where the later timestamp lies before the earlier one."""
    return df.agg(
        F.count_if(parse_ts(later) < parse_ts(earlier)).alias("num_violations")
    )


# --- row-level status columns ---------------------------------------------

def required_status(
    df: DataFrame, columns=REQUIRED_COLUMNS, key: str = KEY, stamps=STAMP_COLUMNS
) -> DataFrame:
    """``missing`` or ``ok`` per required column; an unreadable timestamp is missing."""
    def status(c):
        present = is_stamp_text(c) if c in stamps else F.col(c).isNotNull()
        return F.when(present, "ok").otherwise("missing").alias(f"{c}_status")

    return df.select(key, *[status(c) for c in columns])


def domain_status(
    df: DataFrame, column: str = "BORO_NM", values=BOROUGHS, key: str = KEY
) -> DataFrame:
    """``invalid`` where a value lies outside the domain; null is ``ok``."""
    status = F.when(~F.col(column).isin(*values), "invalid").otherwise("ok")
    return df.select(key, column, status.alias(f"{column}_status"))


def date_order_status(df: DataFrame, key: str = KEY) -> DataFrame:
    """Incident date against the call date and against the closing time."""
    incident = parse_date("INCIDENT_DATE")
    before = incident < parse_date("CREATE_DATE")
    after = incident.cast("timestamp_ntz") > parse_ts("CLOSNG_TS")
    return df.select(
        key,
        F.when(before, "before_CREATE_DATE").otherwise("ok").alias("INCIDENT_DATE_check1"),
        F.when(after, "after_CLOSNG_TS").otherwise("ok").alias("INCIDENT_DATE_check2"),
    )


def order_status(df: DataFrame, key: str = KEY) -> DataFrame:
    """Untrimmed time format and dispatch order; a null on either side is ``ok``."""
    bad_time = ~is_time_text("INCIDENT_TIME")
    bad_order = parse_ts("DISP_TS") < parse_ts("ADD_TS")
    return df.select(
        key,
        F.when(bad_time, "invalid").otherwise("ok").alias("INCIDENT_TIME_status"),
        F.when(bad_order, "DISP_before_ADD").otherwise("ok").alias("DISP_ADD_check"),
    )


def domain_listing(df: DataFrame, column: str = "BORO_NM") -> DataFrame:
    """Distinct values left after cleaning, each beside the number of them.

    A domain is short by nature, but nothing here relies on it: the count is a
    scalar subquery, and the values stay spread over their partitions.
    """
    values = distinct_values(df, column)
    total = values.agg(F.count("*").alias("n")).scalar()
    return values.withColumn("num_distinct", total)
