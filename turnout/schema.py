"""Column lists, schemas and fixed lookup values of the call table.

One row is one call for service.  The table passes through four shapes:
``raw`` (all text) -> ``cleaned`` (typed, with durations) -> ``scoped``
(three severities, plausible responses) -> ``normalized`` (upper-case text,
12-hour clock).
"""

from pyspark.sql import types as T

# --- fixed values: formats of the raw text -------------------------------
# MM/dd/yyyy, HH:mm:ss and MM/dd/yyyy hh:mm:ss a; whether a month has the day is not theirs to say.
DATE_PATTERN = r"^(0[1-9]|1[0-2])/(0[1-9]|[12][0-9]|3[01])/[0-9]{4}\z"
CLOCK_PATTERN = r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\z"
STAMP_PATTERN = (
    r"^(0[1-9]|1[0-2])/(0[1-9]|[12][0-9]|3[01])/[0-9]{4} "
    r"(0[1-9]|1[0-2]):[0-5][0-9]:[0-5][0-9] [AaPp][Mm]\z"
)
TIME_PATTERN = r"^([01]?[0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"

# --- fixed values: domains ------------------------------------------------
BOROUGHS = ("BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND")
SEVERITIES = ("CRITICAL", "SERIOUS", "NON CRITICAL")
NON_CRITICAL = "NON CRITICAL"
NULL_TEXT = "(null)"

# First two characters of the radio code -> call type.
CODE_TO_TYPE = {
    "10": "INVESTIGATE/POSSIBLE CRIME",
    "13": "ASSIST POLICE OFFICER",
    "30": "ROBBERY (IN PROGRESS)",
    "31": "BURGLARY (IN PROGRESS)",
    "32": "LARCENY (IN PROGRESS)",
    "34": "ASSAULT (IN PROGRESS)",
    "39": "OTHER CRIMES (IN PROGRESS)",
    "51": "ROVING BAND",
    "66": "UNUSUAL INCIDENT",
}
UNKNOWN_TYPE = "UNKNOWN"

# Tags of the two ends of a ranking, for the k first and the k last.
FASTEST = "TOP_{k}_FASTEST"
SLOWEST = "BOTTOM_{k}_SLOWEST"

# --- fixed values: columns --------------------------------------------------------------
KEY = "CAD_EVNT_ID"
DATE_COLUMNS = ("CREATE_DATE", "INCIDENT_DATE")
STAMP_COLUMNS = ("ADD_TS", "DISP_TS", "ARRIVD_TS", "CLOSNG_TS")
TEXT_COLUMNS = ("BORO_NM", "RADIO_CODE", "TYP_DESC", "CIP_JOBS")
CATEGORY_COLUMNS = ("BORO_NM", "RADIO_CODE", "TYP_DESC_ENUM", "CIP_JOBS")

RAW_COLUMNS = (
    "CAD_EVNT_ID", "CREATE_DATE", "INCIDENT_DATE", "INCIDENT_TIME",
    "NYPD_PCT_CD", "BORO_NM", "RADIO_CODE", "TYP_DESC", "CIP_JOBS",
    "ADD_TS", "DISP_TS", "ARRIVD_TS", "CLOSNG_TS",
)

# Duration column -> (start, end).
DURATIONS = {
    "RESPONSE_TIME": ("ADD_TS", "ARRIVD_TS"),
    "DISPATCH_DELAY": ("ADD_TS", "DISP_TS"),
    "TRAVEL_TIME": ("DISP_TS", "ARRIVD_TS"),
}
SECONDS_COLUMNS = tuple(f"{name}_SEC" for name in DURATIONS)


def _struct(**types):
    return T.StructType([T.StructField(name, kind, True) for name, kind in types.items()])


RAW = _struct(**{name: T.StringType() for name in RAW_COLUMNS})

# The older export carries the patrol borough next to the borough.
RAW_WITH_PATROL = T.StructType(
    RAW.fields[:6] + [T.StructField("PATRL_BORO_NM", T.StringType(), True)] + RAW.fields[6:]
)

CLEANED = _struct(
    CAD_EVNT_ID=T.StringType(),
    CREATE_DATE=T.DateType(),
    INCIDENT_DATE=T.DateType(),
    INCIDENT_TIME=T.StringType(),
    NYPD_PCT_CD=T.IntegerType(),
    BORO_NM=T.StringType(),
    RADIO_CODE=T.StringType(),
    TYP_DESC=T.StringType(),
    TYP_DESC_ENUM=T.LongType(),
    CIP_JOBS=T.StringType(),
    ADD_TS=T.TimestampNTZType(),
    DISP_TS=T.TimestampNTZType(),
    ARRIVD_TS=T.TimestampNTZType(),
    CLOSNG_TS=T.TimestampNTZType(),
    RESPONSE_TIME=T.StringType(),
    DISPATCH_DELAY=T.StringType(),
    TRAVEL_TIME=T.StringType(),
    RESPONSE_TIME_SEC=T.LongType(),
    DISPATCH_DELAY_SEC=T.LongType(),
    TRAVEL_TIME_SEC=T.LongType(),
)

# Scoping drops rows and normalising rewrites text in place: same shape.
NORMALIZED = CLEANED
