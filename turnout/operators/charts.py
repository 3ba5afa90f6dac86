"""Chart-ready tables from the marts.

Bars are drawn from the ``HH:mm:ss`` text of a mart, so minutes come from that
text.  Drawing is left to the plotting tool of choice.
"""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from turnout.functions import hms_to_minutes, pair_label
from turnout.schema import BOROUGHS, FASTEST, SEVERITIES, SLOWEST

# By the beginning of a tag, which names the side whatever the k in it.
COLOURS = {FASTEST.split("{")[0]: "green", SLOWEST.split("{")[0]: "red"}
OTHER_BOROUGHS = "OTHER_BOROUGHS"


def chart_borough(mart: DataFrame) -> DataFrame:
    """Average minutes and number of calls per borough."""
    return mart.select(
        "BORO_NM", hms_to_minutes("AVG_RESPONSE_TIME").alias("AVG_MIN"), "NUM_RECORDS"
    )


def chart_pair_cells(mart: DataFrame, severities=SEVERITIES) -> DataFrame:
    """Mean minutes with one row per type, severity and borough, whatever boroughs there are.

    The mean runs over the mart's rows, unweighted.  Rows go by severity (any
    unlisted one last), type and borough; a pair with a missing part has no row.
    """
    cells = _cells(mart, severities)
    return (
        cells.groupBy("INCIDENT_PAIR", "SEVERITY_ORDER", "TYP_DESC", "CIP_JOBS", "BORO_NM")
        .agg(F.avg("AVG_MIN").alias("AVG_MIN"))
        .orderBy("SEVERITY_ORDER", "TYP_DESC", "CIP_JOBS", F.asc_nulls_last("BORO_NM"))
        .drop("TYP_DESC", "CIP_JOBS")
    )


def _cells(mart: DataFrame, severities) -> DataFrame:
    place = reduce(
        lambda chain, item: chain.when(F.col("CIP_JOBS") == item[1], item[0]),
        enumerate(severities),
        F.when(F.lit(False), -1),
    ).otherwise(len(severities))
    return mart.select(
        "TYP_DESC", "CIP_JOBS", "BORO_NM",
        pair_label("TYP_DESC", "CIP_JOBS").alias("INCIDENT_PAIR"),
        place.alias("SEVERITY_ORDER"),
        hms_to_minutes("AVG_RESPONSE_TIME").alias("AVG_MIN"),
    ).where(F.col("INCIDENT_PAIR").isNotNull())


def chart_pair_matrix(mart: DataFrame, boroughs=BOROUGHS, severities=SEVERITIES) -> DataFrame:
    """The same with one row per type and severity and one column per borough.

    All boroughs that are not listed, a missing one too, share the last column, as the mean
    over their rows.  A borough without calls has a null cell.
    """
    listed = F.when(F.col("BORO_NM").isin(*boroughs), F.col("BORO_NM")).otherwise(OTHER_BOROUGHS)
    return (
        _cells(mart, severities).withColumn("_column", listed)
        .groupBy("INCIDENT_PAIR", "SEVERITY_ORDER", "TYP_DESC", "CIP_JOBS")
        .pivot("_column", [*boroughs, OTHER_BOROUGHS])
        .agg(F.avg("AVG_MIN"))
        .orderBy("SEVERITY_ORDER", "TYP_DESC", "CIP_JOBS")
        .drop("TYP_DESC", "CIP_JOBS")
    )


def chart_precinct_points(mart: DataFrame) -> DataFrame:
    """One point per precinct: calls against average minutes, by borough."""
    return mart.select(
        "BORO_NM", "NYPD_PCT_CD", "NUM_RECORDS",
        hms_to_minutes("AVG_RESPONSE_TIME").alias("AVG_MIN"),
    )


def chart_facets(mart: DataFrame) -> DataFrame:
    """The (type, severity) pairs that get a panel, with their titles."""
    return (
        mart.select("TYP_DESC", "CIP_JOBS").distinct()
        .where(F.col("TYP_DESC").isNotNull() & F.col("CIP_JOBS").isNotNull())
        .withColumn("TITLE", F.concat("TYP_DESC", F.lit(" ("), "CIP_JOBS", F.lit(")")))
    )


def chart_ranked_facets(mart: DataFrame) -> DataFrame:
    """Bars of the ranked mart: panel title, precinct label, minutes, colour."""
    colour = reduce(
        lambda chain, item: chain.when(F.startswith("GROUP_TYPE", F.lit(item[0])), item[1]),
        COLOURS.items(),
        F.when(F.lit(False), ""),
    )
    return (
        mart.where(F.col("TYP_DESC").isNotNull() & F.col("CIP_JOBS").isNotNull())
        .select(
            F.concat("TYP_DESC", F.lit(" ("), "CIP_JOBS", F.lit(")")).alias("TITLE"),
            F.col("NYPD_PCT_CD").cast("string").alias("PRECINCT"),
            hms_to_minutes("AVG_RESPONSE_TIME").alias("AVG_MIN"),
            colour.alias("COLOUR"),
        )
        .orderBy("TITLE", "AVG_MIN", "PRECINCT", "COLOUR")
    )


def chart_severity(mart: DataFrame) -> DataFrame:
    """Average minutes and number of calls per severity."""
    return mart.select(
        "CIP_JOBS", hms_to_minutes("avg_response_time").alias("AVG_MIN"), "num_records"
    )


def _stacked(mart: DataFrame, axis: str, dispatch: str, *more) -> DataFrame:
    # The travel bar stands on the dispatch bar.
    return mart.select(
        axis,
        hms_to_minutes(dispatch).alias("DISPATCH_MIN"),
        hms_to_minutes("avg_travel_time").alias("TRAVEL_MIN"),
        hms_to_minutes(dispatch).alias("TRAVEL_BASE_MIN"),
        *more,
    )


def chart_severity_stack(mart: DataFrame) -> DataFrame:
    return _stacked(mart, "CIP_JOBS", "avg_dispatch_time")


def chart_hourly(mart: DataFrame) -> DataFrame:
    """Stacked minutes and call volume per hour."""
    return _stacked(mart, "hour_of_day", "avg_dispatch_delay_time", "num_records")
