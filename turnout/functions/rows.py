"""Expressions and projections over several columns of one row."""

from pyspark.sql import Column, DataFrame, functions as F

from turnout.functions.clock import hms_to_seconds
from turnout.functions.text import normalized_text
from turnout.schema import DURATIONS, TEXT_COLUMNS


def null_count(columns) -> Column:
    """Number of null columns in a row."""
    return F.expr(" + ".join(f"int(`{c}` is null)" for c in columns))


def add_seconds(df: DataFrame, columns=tuple(DURATIONS)) -> DataFrame:
    """Add ``<column>_SEC`` for each ``HH:mm:ss`` column."""
    return df.withColumns({f"{c}_SEC": hms_to_seconds(c) for c in columns})


def normalize_text(df: DataFrame, columns=TEXT_COLUMNS) -> DataFrame:
    return df.withColumns({c: normalized_text(c) for c in columns})


#: Hour of day, month and weekday (``Mon`` ... ``Sun``) of a timestamp.
CALENDAR = {
    "hour_of_day": F.hour,
    "month": F.month,
    "day_of_week": lambda ts: F.date_format(ts, "E"),
}


def calendar_parts(df: DataFrame, ts: str = "ADD_TS", parts=tuple(CALENDAR)) -> DataFrame:
    """Add the calendar parts of a timestamp."""
    return df.withColumns({part: CALENDAR[part](ts) for part in parts})
