"""Queries that promise an order, row by row in sequence."""

import pytest

from oracle import statements
from tests.compare import connect, duck_sequence, spark_sequence
from turnout.plans import catalog

#: Query -> what its rows are sorted by, as SQL that leaves no ties.
ORDERED = {
    "raw_desc_violation_counts": "num_codes desc, TYP_DESC nulls last",
    "raw_desc_to_codes": "num_codes desc, TYP_DESC nulls last",
    "raw_desc_to_severity": "num_CIP_JOBS desc, TYP_DESC nulls last",
    "raw_late_incidents_first": "CAD_EVNT_ID nulls last, CREATE_DATE, INCIDENT_DATE, INCIDENT_TIME, NYPD_PCT_CD",
    "borough_profile": "AVG_RESPONSE_SEC desc, BORO_NM",
    "borough_profile_seconds": "avg_response_sec desc, BORO_NM",
    "borough_detail": "INCIDENT_COUNT desc, BORO_NM, RADIO_CODE_PREFIX, CIP_JOBS",
    "borough_detail_by_borough": "BORO_NM, AVG_RESPONSE_SEC desc, RADIO_CODE_PREFIX, CIP_JOBS",
    "borough_detail_by_type": "TYP_DESC, CIP_JOBS, AVG_RESPONSE_SEC desc, BORO_NM, RADIO_CODE_PREFIX",
    "precinct_profile": "AVG_RESPONSE_SEC desc, BORO_NM, NYPD_PCT_CD",
    "severity_profile": "avg_response_sec, CIP_JOBS",
    "dispatch_by_precinct": "avg_dispatch_sec desc, BORO_NM, NYPD_PCT_CD",
    "travel_by_precinct": "avg_travel_sec desc, BORO_NM, NYPD_PCT_CD",
    "borough_by_type": "TYP_DESC_ENUM, avg_response_sec desc, BORO_NM",
    "hourly_noncritical": "hour_of_day nulls last",
    "hourly_high_severity": "hour_of_day nulls last",
    "profile_by_hour": "hour_of_day nulls last",
    "profile_by_month": "month nulls last",
    "hour_by_borough": "hour_of_day nulls last, avg_response_sec desc, BORO_NM",
    "hour_by_severity": "hour_of_day nulls last, avg_response_sec desc, CIP_JOBS",
    "slowest_precincts": "avg_response_sec desc, BORO_NM, NYPD_PCT_CD",
    "fastest_precincts": "avg_response_sec, BORO_NM, NYPD_PCT_CD",
    "slowest_dispatch": "avg_dispatch_sec desc, BORO_NM, NYPD_PCT_CD",
    "fastest_travel": "avg_travel_sec, BORO_NM, NYPD_PCT_CD",
    "slowest_hours": "avg_response_sec desc, hour_of_day",
    "slowest_months": "avg_response_sec desc, month",
    "mart_preview": "AVG_RESPONSE_SEC desc, BORO_NM, NYPD_PCT_CD",
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_rows_come_in_order(spark, small, name):
    with connect(small) as con:
        expected = duck_sequence(con, statements()[name], ORDERED[name])
    assert spark_sequence(catalog.build()[name](spark, small)) == expected


def test_a_wrong_order_is_seen(spark, small):
    with connect(small) as con:
        expected = duck_sequence(con, statements()["slowest_precincts"], ORDERED["slowest_precincts"])
    df = catalog.build()["slowest_precincts"](spark, small)
    assert spark_sequence(df.orderBy("avg_response_sec")) != expected
