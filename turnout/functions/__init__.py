from turnout.functions.clock import (
    elapsed_seconds,
    format_hms,
    hms_to_minutes,
    hms_to_seconds,
    incident_ts,
    is_stamp_text,
    is_time_text,
    parse_date,
    parse_ts,
    time_to_12h,
)
from turnout.functions.rows import add_seconds, calendar_parts, normalize_text, null_count
from turnout.functions.text import code_prefix, is_blank, map_code, normalized_text, pair_label

__all__ = [
    "add_seconds", "calendar_parts", "code_prefix", "elapsed_seconds", "format_hms",
    "hms_to_minutes", "hms_to_seconds", "incident_ts", "is_blank", "is_stamp_text", "is_time_text",
    "map_code", "normalize_text", "normalized_text", "null_count", "pair_label",
    "parse_date", "parse_ts", "time_to_12h",
]
