"""Every operator as a named query over the star-schema tables.

Each entry takes a session and the folder of the tables.  ``raw_*`` queries
profile the raw text, ``etl_*`` the cleaning, the rest the normalized calls;
``lineitem_*`` run the same operators over one call per order line.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from turnout.functions import add_seconds, format_hms
from turnout.operators import (
    charts,
    cleaning,
    encoding,
    ledger,
    numbering,
    overview,
    profiles,
    quality,
    ranking,
    sketches,
)
from turnout.plans.stages import clean, normalize, scope, type_calls
from turnout.schema import DURATIONS, SECONDS_COLUMNS
from turnout.sources import preview_mart
from turnout.sources.bindings import line_calls, line_count, patrol_calls, raw_calls

Query = Callable[[SparkSession, str], DataFrame]

# Region names of the supplied tables, in the place of boroughs.
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
PRECINCT = ["BORO_NM", "NYPD_PCT_CD"]


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Standard deviations differ between engines in the last digits only."""
    return df.withColumns({
        c: F.round(c, places) for c in df.columns
        if "stddev" in c.lower() and not c.lower().endswith("_time")
    })


def _as_text(df: DataFrame, set_name: str) -> DataFrame:
    return df.withColumn(set_name, F.array_join(set_name, ", "))


def deduped_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.dedup_most_complete(raw_calls(spark, sf_dir))


def typed_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_calls(deduped_calls(spark, sf_dir))


def cleaned_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_calls(spark, sf_dir))


def normalized_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(scope(cleaned_calls(spark, sf_dir)))


def _on(source: Query, step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: step(source(spark, sf_dir))


def _raw(step) -> Query:
    return _on(raw_calls, step)


def _calls(step) -> Query:
    return _on(normalized_calls, lambda df: _rounded(step(df)))


def _lines(step) -> Query:
    return _on(line_calls, lambda df: _rounded(step(df)))


def _profiling() -> dict[str, Query]:
    q = quality

    def violations(key, value, set_name, count_name):
        return _raw(lambda df: _as_text(
            q.dependency_violations(df, key, value, set_name, count_name), set_name
        ))

    return {
        "raw_row_count": _raw(q.row_count),
        "raw_distinct_values_borough": _raw(lambda df: q.distinct_values(df, "BORO_NM")),
        "raw_distinct_counts": _raw(q.distinct_counts),
        "raw_pair_count": _raw(lambda df: q.distinct_pair_count(df, "RADIO_CODE", "TYP_DESC")),
        "raw_desc_to_codes": violations("TYP_DESC", "RADIO_CODE", "RADIO_CODES", "num_codes"),
        "raw_code_to_descs": violations("RADIO_CODE", "TYP_DESC", "TYP_DESCS", "num_descs"),
        "raw_desc_to_severity": violations(
            "TYP_DESC", "CIP_JOBS", "CIP_JOBS_set", "num_CIP_JOBS"
        ),
        "raw_desc_to_codes_pairs": _raw(
            lambda df: q.dependency_pairs(df, "TYP_DESC", "RADIO_CODE", "num_codes")
        ),
        "raw_code_to_descs_pairs": _raw(
            lambda df: q.dependency_pairs(df, "RADIO_CODE", "TYP_DESC", "num_descs")
        ),
        "raw_desc_to_severity_pairs": _raw(
            lambda df: q.dependency_pairs(df, "TYP_DESC", "CIP_JOBS", "num_CIP_JOBS")
        ),
        "raw_desc_severity_map_pairs": _raw(
            lambda df: q.dependency_map_pairs(df, "TYP_DESC", "CIP_JOBS", "num_CIP_JOBS")
        ),
        "raw_desc_violation_counts": _raw(
            lambda df: q.violation_counts(df, "TYP_DESC", "RADIO_CODE", "num_codes")
        ),
        "raw_desc_severity_map": _raw(lambda df: _as_text(
            q.dependency_map(df, "TYP_DESC", "CIP_JOBS", "CIP_JOBS_set", "num_CIP_JOBS"),
            "CIP_JOBS_set",
        )),
        "raw_missing_desc": _raw(
            lambda df: q.missing_values(df, "TYP_DESC", ["RADIO_CODE", "TYP_DESC"])
        ),
        "raw_duplicate_keys": _raw(q.duplicate_keys),
        "raw_max_length": _raw(lambda df: q.max_length(df, "TYP_DESC")),
        "raw_date_range": _raw(q.date_range),
        "raw_late_incidents": _raw(q.late_incidents),
        "raw_late_incidents_count": _raw(lambda df: q.row_count(q.late_incidents(df, 60))),
        "raw_late_incidents_first": _raw(lambda df: ranking.top_k(
            q.late_incidents(df, 60), "CAD_EVNT_ID", 10, ascending=True, ties=df.columns)),
        "raw_late_incidents_strict": _raw(lambda df: q.row_count(q.late_incidents(df, 0))),
        "raw_time_status": _raw(q.time_status),
        "raw_status_counts": _raw(q.status_counts),
        "raw_dispatch_before_add": _raw(q.order_violations),
        # The patrol borough is in the older export only.
        "raw_required_status": _raw(lambda df: q.required_status(
            df, [c for c in q.REQUIRED_COLUMNS if c != "PATRL_BORO_NM"]
        )),
        "raw_required_status_patrol": _on(patrol_calls, q.required_status),
        "raw_domain_status": _raw(lambda df: q.domain_status(df, "BORO_NM", REGIONS)),
        "raw_date_order_status": _raw(q.date_order_status),
        "raw_order_status": _raw(q.order_status),
        "raw_overview": _raw(lambda df: overview.profile_raw(df, REGIONS)),
        "raw_distinct_sketches": _raw(_sketched_counts),
        "raw_desc_severity_cells": _raw(lambda df: _as_text(q.dependency_cells(
            df, "TYP_DESC", "CIP_JOBS", "CIP_JOBS_set", "num_CIP_JOBS"), "CIP_JOBS_set")),
        "cleaned_borough_domain": _on(cleaned_calls, q.domain_listing),
    }


def _sketched_counts(df: DataFrame) -> DataFrame:
    """Exact distinct counts of columns and a pair, and whether merged sketches of two halves come near them."""
    pair = ("RADIO_CODE", "TYP_DESC")
    halves = F.pmod(F.xxhash64(*df.columns), F.lit(2))
    parts = [sketches.distinct_sketches(df.where(halves == i), pairs=[pair]) for i in (0, 1)]
    found = sketches.estimates(sketches.merged(parts[0].unionByName(parts[1])))
    exact = quality.distinct_counts(df).unionByName(quality.distinct_pair_count(df, *pair).select(
        F.lit(", ".join(pair)).alias("column_name"), F.col("num_pairs").alias("num_distinct")))
    near = F.abs(found.num_distinct - exact.num_distinct) <= 3 * sketches.relative_error() * exact.num_distinct
    return exact.join(found, "column_name").select(
        "column_name", exact.num_distinct, near.alias("sketch_is_near"))


def _cleaning() -> dict[str, Query]:
    def coded(mode):
        return _on(deduped_calls, lambda df: encoding.encode_category(
            df, "TYP_DESC", mode=mode
        ).select("CAD_EVNT_ID", "TYP_DESC", "TYP_DESC_ENUM"))

    def wrapped(df):
        return df.select("CAD_EVNT_ID", *[
            format_hms(f"{name}_SEC", wrap24=True).alias(name) for name in DURATIONS
        ])

    return {
        "etl_dedup": deduped_calls,
        "etl_typed_durations": _on(typed_calls, lambda df: df.drop("INCIDENT_TS")),
        "etl_category_index": coded("index"),
        "etl_category_dense_rank": coded("dense_rank"),
        "etl_valid_borough": _on(typed_calls, lambda df: df.where(
            cleaning.valid_borough()).select("CAD_EVNT_ID", "BORO_NM")),
        "etl_dispatch_order": _on(typed_calls, lambda df: df.where(
            cleaning.dispatched_in_order()).select("CAD_EVNT_ID", "ADD_TS", "DISP_TS")),
        "etl_incident_tolerance": _on(typed_calls, lambda df: df.where(
            cleaning.incident_within(60)).select("CAD_EVNT_ID", "INCIDENT_TS", "ADD_TS")),
        "etl_clean": cleaned_calls,
        "etl_scope": _on(cleaned_calls, scope),
        "etl_normalize": normalized_calls,
        "etl_reject_ledger": lambda spark, sf_dir: ledger.rejects(
            typed_calls(spark, sf_dir), ledger.clean_rules(), "clean"
        ).unionByName(ledger.rejects(cleaned_calls(spark, sf_dir), ledger.scope_rules(), "scope")),
        "etl_hms_wrap24": _on(typed_calls, wrapped),
        # From the texts alone, as a table has them that carries no seconds.
        "etl_normalize_from_text": _on(cleaned_calls, lambda df: normalize(scope(add_seconds(
            df.drop(*SECONDS_COLUMNS), ["RESPONSE_TIME"])).drop("RESPONSE_TIME_SEC"))),
    }


def _statistics() -> dict[str, Query]:
    return {
        "stats_means": _calls(profiles.means),
        "stats_medians": _calls(profiles.medians),
        "stats_stddevs": _calls(profiles.stddevs),
        "stats_modes": _calls(profiles.modes),
    }


def _grouped() -> dict[str, Query]:
    p = profiles

    def seconds(keys):
        return _calls(lambda df: p.metric_profile(df, keys, "response", p.RESPONSE))

    def severity_seconds(df):
        profile = p.severity_profile(df)
        return profile.select(*[c for c in profile.columns if not c.endswith("_time")])

    def hourly(split, metrics=None):
        return _calls(lambda df: p.hourly_profile(df, split, metrics))

    short = {"response": p.RESPONSE}
    return {
        "borough_profile": _calls(p.borough_profile),
        "borough_profile_seconds": seconds(["BORO_NM"]),
        "borough_detail": _calls(p.borough_detail),
        "borough_detail_by_borough": _calls(lambda df: p.borough_listing(df, "borough")),
        "borough_detail_by_type": _calls(lambda df: p.borough_listing(df, "type")),
        "precinct_profile": _calls(p.precinct_profile),
        "precinct_profile_seconds": seconds(PRECINCT),
        "precinct_detail": _calls(p.precinct_detail),
        "severity_profile": _calls(p.severity_profile),
        "severity_profile_seconds": _calls(severity_seconds),
        "dispatch_by_borough": _calls(lambda df: p.dispatch_profile(df, ["BORO_NM"])),
        "dispatch_by_precinct": _calls(lambda df: p.dispatch_profile(df, PRECINCT)),
        "travel_by_borough": _calls(lambda df: p.travel_profile(df, ["BORO_NM"])),
        "travel_by_precinct": _calls(lambda df: p.travel_profile(df, PRECINCT)),
        "borough_by_type": _calls(p.borough_by_type),
        "hourly_noncritical": hourly("non_critical"),
        "hourly_high_severity": hourly("high_severity"),
        "hourly_noncritical_short": hourly("non_critical", short),
        "hourly_high_severity_short": hourly("high_severity", short),
        "profile_by_hour": _calls(lambda df: p.calendar_profile(df, "hour_of_day")),
        "profile_by_month": _calls(lambda df: p.calendar_profile(df, "month")),
        "profile_by_weekday": _calls(lambda df: p.calendar_profile(df, "day_of_week")),
        "hour_by_borough": _calls(lambda df: p.hour_cross_profile(df, "BORO_NM")),
        "hour_by_severity": _calls(lambda df: p.hour_cross_profile(df, "CIP_JOBS")),
    }


def _ranked() -> dict[str, Query]:
    p, top = profiles, ranking.top_k

    def precincts(name, metric, ascending):
        return _calls(lambda df: top(
            p.metric_profile(df, PRECINCT, name, metric), f"avg_{name}_sec", 10, ascending, PRECINCT
        ))

    def slowest_parts(part):
        return _calls(lambda df: top(
            p.calendar_profile(df, part), "avg_response_sec", 5, ties=[part]
        ))

    def slowest_of_split(split):
        return _calls(lambda df: top(
            p.hourly_profile(df, split, {"response": p.RESPONSE}),
            "avg_response_sec", 5, ties=["hour_of_day"],
        ))

    return {
        "precinct_ranks": _calls(lambda df: numbering.rank_groups(
            p.response_detail(df, "precinct"))),
        "precinct_ranks_in_slices": _calls(lambda df: numbering.ranks_in_slices(
            p.response_detail(df, "precinct"))),
        "precinct_top_bottom": _calls(ranking.precinct_ranked),
        "precinct_top_bottom_3": _calls(lambda df: ranking.precinct_ranked(df, k=3)),
        "slowest_precincts": precincts("response", p.RESPONSE, False),
        "fastest_precincts": precincts("response", p.RESPONSE, True),
        "slowest_dispatch": precincts("dispatch", p.DISPATCH, False),
        "fastest_dispatch": precincts("dispatch", p.DISPATCH, True),
        "slowest_travel": precincts("travel", p.TRAVEL, False),
        "fastest_travel": precincts("travel", p.TRAVEL, True),
        "slowest_hours": slowest_parts("hour_of_day"),
        "slowest_hours_noncritical": slowest_of_split("non_critical"),
        "slowest_hours_high_severity": slowest_of_split("high_severity"),
        "slowest_months": slowest_parts("month"),
        "mart_preview": _calls(lambda df: preview_mart(
            p.precinct_profile(df), "AVG_RESPONSE_SEC", 5, ties=PRECINCT)),
    }


def _charts() -> dict[str, Query]:
    c, p = charts, profiles

    def matrix(listed):
        def wide(df):
            table = c.chart_pair_matrix(p.borough_detail(df), listed)
            return table.withColumns({
                name: F.round(F.col(f"`{name}`"), 6) for name in (*listed, c.OTHER_BOROUGHS)
            })

        return wide

    return {
        "chart_borough": _calls(lambda df: c.chart_borough(p.borough_profile(df))),
        "chart_pair_matrix": _calls(matrix(REGIONS)),
        # Two regions are not listed.
        "chart_pair_matrix_other": _calls(matrix(REGIONS[:3])),
        "chart_pair_cells": _calls(lambda df: c.chart_pair_cells(p.borough_detail(df)).withColumn(
            "AVG_MIN", F.round("AVG_MIN", 6))),
        "chart_precinct_points": _calls(
            lambda df: c.chart_precinct_points(p.precinct_profile(df))),
        "chart_facets": _calls(lambda df: c.chart_facets(ranking.precinct_ranked(df))),
        "chart_ranked_facets": _calls(
            lambda df: c.chart_ranked_facets(ranking.precinct_ranked(df))),
        "chart_ranked_facets_3": _calls(
            lambda df: c.chart_ranked_facets(ranking.precinct_ranked(df, k=3))),
        "chart_severity": _calls(lambda df: c.chart_severity(p.severity_profile(df))),
        "chart_severity_stack": _calls(
            lambda df: c.chart_severity_stack(p.severity_profile(df))),
        "chart_hourly": _calls(
            lambda df: c.chart_hourly(p.hourly_profile(df, "non_critical"))),
        "chart_hourly_high_severity": _calls(
            lambda df: c.chart_hourly(p.hourly_profile(df, "high_severity"))),
    }


def _order_lines() -> dict[str, Query]:
    p = profiles
    return {
        "lineitem_group_profile": _lines(lambda df: p.group_profile(
            df.where(cleaning.positive()), ["BORO_NM"])),
        "lineitem_precinct_detail": _lines(p.precinct_detail),
        "lineitem_top_bottom": _lines(ranking.precinct_ranked),
        "lineitem_severity_profile": _lines(p.severity_profile),
        "lineitem_profile_by_hour": _lines(lambda df: p.calendar_profile(df, "hour_of_day")),
        "lineitem_ranks_in_slices": _lines(lambda df: numbering.ranks_in_slices(
            df.select("CAD_EVNT_ID", "BORO_NM", "RESPONSE_TIME_SEC").distinct(), ["BORO_NM"], "RESPONSE_TIME_SEC",
            ["CAD_EVNT_ID"])),
        "lineitem_dedup": lambda spark, sf_dir: cleaning.dedup_most_complete(
            line_calls(spark, sf_dir), n_rows=line_count(spark, sf_dir)),
    }


def build() -> dict[str, Query]:
    return {
        **_profiling(), **_cleaning(), **_statistics(), **_grouped(), **_ranked(), **_charts(),
        **_order_lines(),
    }
