"""The table-to-table steps: raw -> cleaned -> scoped -> normalized."""

from pyspark.sql import DataFrame, Observation, functions as F

from turnout.functions import (
    add_seconds,
    incident_ts,
    normalize_text,
    parse_date,
    parse_ts,
    time_to_12h,
)
from turnout.operators.cleaning import dedup_most_complete, typed, with_durations
from turnout.operators.encoding import category_codes, encode_category
from turnout.operators.ledger import apply_rules, clean_rules, scope_rules
from turnout.schema import CLEANED, DATE_COLUMNS, DURATIONS, STAMP_COLUMNS


def type_calls(deduped: DataFrame, wrap24: bool = False) -> DataFrame:
    """Typed columns, durations and the incident timestamp of deduplicated raw rows.

    The incident timestamp is put together from the two texts before the date
    is typed; afterwards its format would no longer fit.

    The three timestamps that row filters test come out of a one-row ``inline``:
    a filter does not move below it, so these texts are parsed once per row and
    not once more for each filter.
    """
    tested = ("ADD_TS", "DISP_TS")
    once = F.struct(
        incident_ts("INCIDENT_DATE", "INCIDENT_TIME").alias("INCIDENT_TS"),
        *[parse_ts(c).alias(c) for c in tested],
    )
    stamped = deduped.select(
        *[c for c in deduped.columns if c not in tested], F.inline(F.array(once))
    )
    rest = [c for c in STAMP_COLUMNS if c not in tested]
    return with_durations(typed(stamped, rest), wrap24)


def clean_typed(
    calls: DataFrame, codes: DataFrame | None = None, tolerance: int = 60, seen: Observation | None = None
) -> DataFrame:
    """Coded and filtered calls from typed ones; ``seen`` gets what each filter drops.

    Category codes number every description of the deduplicated table, also
    of rows that the filters drop, and before case and blanks are normalised.
    """
    coded = encode_category(calls, "TYP_DESC", codes=codes)
    return apply_rules(coded, clean_rules(tolerance), seen).select(*CLEANED.names)


def clean(
    raw: DataFrame, tolerance: int = 60, null_keys: str = "collapse", wrap24: bool = False
) -> DataFrame:
    """Stage 1: raw text to the typed table."""
    deduped = dedup_most_complete(raw, null_keys=null_keys)
    # Codes need the description only, so they come from the untyped rows.
    codes = category_codes(deduped, "TYP_DESC")
    return clean_typed(type_calls(deduped, wrap24), codes, tolerance)


def scope(cleaned: DataFrame, min_response: int = 90, seen: Observation | None = None) -> DataFrame:
    """Stage 2: the three severities, with a response of more than 90 seconds."""
    return apply_rules(cleaned, scope_rules(min_response), seen)


def normalize(scoped: DataFrame) -> DataFrame:
    """Stage 3: seconds, dates and timestamps typed where they are text, 12-hour clock, upper-case text.

    Exact seconds are kept where the table has them; otherwise they are read
    back from the duration text.
    """
    missing = [c for c in DURATIONS if f"{c}_SEC" not in scoped.columns]
    if missing:
        scoped = add_seconds(scoped, missing)
    text = {name for name, kind in scoped.dtypes if kind == "string"}
    return normalize_text(scoped.withColumns({
        **{c: parse_date(c) for c in DATE_COLUMNS if c in text},
        **{c: parse_ts(c) for c in STAMP_COLUMNS if c in text},
        "INCIDENT_TIME": time_to_12h("INCIDENT_TIME"),
    }))
