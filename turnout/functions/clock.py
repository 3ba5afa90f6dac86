"""Date, time and duration expressions.

Bad text becomes null and never raises, also under ANSI mode.  Timestamps have no time zone:
they are what the clock on the wall said, 02:30 on any night included.  Durations are the
whole seconds between two such readings.  Neither depends on the session time zone, so a stage
reads alike wherever it was written.
"""

from pyspark.sql import Column, functions as F

from turnout.schema import CLOCK_PATTERN, DATE_PATTERN, STAMP_PATTERN, TIME_PATTERN

DAY = 86400


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _number(text: Column, start: int, size: int) -> Column:
    return F.substring(text, start, size).try_cast("int")


def _reading(date: Column, hour: Column, time: Column, at: int) -> Column:
    """Timestamp without zone of a date text, an hour, and the minutes and seconds from place ``at`` of a text.

    Texts are of the right form; what no calendar has, like 30 February, is null.
    """
    return F.try_make_timestamp_ntz(
        _number(date, 7, 4), _number(date, 1, 2), _number(date, 4, 2),
        hour, _number(time, at, 2), _number(time, at + 3, 2),
    )


def parse_date(c) -> Column:
    """Date from ``MM/dd/yyyy`` text."""
    text = _col(c)
    iso = F.concat(F.substring(text, 7, 4), F.lit("-"), F.substring(text, 1, 2), F.lit("-"), F.substring(text, 4, 2))
    return F.when(text.rlike(DATE_PATTERN), iso.try_cast("date"))


def parse_ts(c) -> Column:
    """Timestamp from 12-hour text."""
    text = _col(c)
    noon = F.when(F.substring(text, 21, 1).isin("P", "p"), 12).otherwise(0)
    return F.when(text.rlike(STAMP_PATTERN), _reading(text, _number(text, 12, 2) % 12 + noon, text, 15))


def is_stamp_text(c) -> Column:
    """Whether ``parse_ts`` reads the text; only days that some months lack are looked up."""
    text = _col(c)
    late = F.substring(text, 4, 2) > "28"
    return text.rlike(STAMP_PATTERN) & (~late | parse_ts(text).isNotNull())


def incident_ts(date, time) -> Column:
    """Timestamp from a date text and a 24-hour time text, null if either is missing."""
    date, time = _col(date), _col(time)
    fits = date.rlike(DATE_PATTERN) & time.rlike(CLOCK_PATTERN)
    return F.when(fits, _reading(date, _number(time, 1, 2), time, 4))


def elapsed_seconds(start, end) -> Column:
    """Whole seconds on the clock from start to end, fractions cut off, negative when end comes first."""
    return (_col(end) - _col(start)).cast("interval second").cast("bigint")


def format_hms(seconds: str, wrap24: bool = False) -> Column:
    """``HH:mm:ss`` text of a column of seconds; fractions are cut off.

    By default hours run past 24 and negative durations carry a minus sign.
    With ``wrap24`` the value is taken modulo one day, which is what formatting
    the seconds as a UTC clock time gives.
    """
    whole = f"bigint(`{seconds}`)"
    sign = "''" if wrap24 else f"if({whole} < 0, '-', '')"
    size = f"pmod({whole}, {DAY})" if wrap24 else f"abs({whole})"
    hours = f"{size} div 3600"
    return F.expr(f"""
        concat(
            {sign},
            if({hours} < 10, concat('0', {hours}), string({hours})), ':',
            lpad(string({size} % 3600 div 60), 2, '0'), ':',
            lpad(string({size} % 60), 2, '0')
        )
    """)


def hms_to_seconds(text: str) -> Column:
    """Seconds from a column of ``HH:mm:ss``, null unless it has three whole numbers."""
    parts = f"split(ltrim('-', `{text}`), ':')"
    hours, minutes, seconds = (f"try_cast(get({parts}, {i}) as bigint)" for i in range(3))
    return F.expr(f"""
        if(startswith(`{text}`, '-'), -1, 1) * ({hours} * 3600 + {minutes} * 60 + {seconds})
    """)


def hms_to_minutes(text: str) -> Column:
    """Minutes as a double from a column of ``HH:mm:ss``."""
    return hms_to_seconds(text) / F.lit(60.0)


def time_to_12h(c) -> Column:
    """``23:05:06`` -> ``11:05:06 PM``; anything that is no time becomes null."""
    text = _col(c)
    hour = _number(text, 1, 2)
    twelve = F.lpad(F.pmod(hour + 11, F.lit(12)) + 1, 2, "0")
    half = F.when(hour < 12, " AM").otherwise(" PM")
    return F.when(text.rlike(CLOCK_PATTERN), F.concat(twelve, F.substring(text, 3, 6), half))


def is_time_text(c) -> Column:
    """Whether the text is a 24-hour time (a one-digit hour is fine)."""
    return _col(c).rlike(TIME_PATTERN)
