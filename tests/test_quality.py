"""Profiling checks on hand-made rows."""

from turnout.operators import quality as q
from turnout.schema import RAW, RAW_COLUMNS


def pairs(spark, rows):
    return spark.createDataFrame(rows, "TYP_DESC string, RADIO_CODE string")


def raw(spark, **columns):
    size = len(next(iter(columns.values())))
    values = {c: columns.get(c, [None] * size) for c in RAW_COLUMNS}
    return spark.createDataFrame(list(zip(*values.values())), RAW)


def test_counts(spark):
    df = pairs(spark, [("a", "1"), ("a", None), (None, None), (None, None)])
    assert tuple(q.row_count(df).first()) == (4, 4)
    assert tuple(q.row_count(df.limit(0)).first()) == (0, 0)
    assert {r[0] for r in q.distinct_values(df, "TYP_DESC").collect()} == {"a", None}
    got = {r.column_name: r.num_distinct
           for r in q.distinct_counts(df, ["TYP_DESC", "RADIO_CODE"]).collect()}
    assert got == {"TYP_DESC": 2, "RADIO_CODE": 2}
    assert q.distinct_pair_count(df, "TYP_DESC", "RADIO_CODE").first()[0] == 3


def test_dependencies(spark):
    df = pairs(spark, [
        ("one", "1"), ("one", "1"), ("one", None),
        ("two", "2"), ("two", "1"), ("three", "3"), ("three", "2"), ("three", "1"),
        (None, "8"), (None, "9"), ("none", None),
    ])
    got = [tuple(r) for r in q.dependency_violations(
        df, "TYP_DESC", "RADIO_CODE", "codes", "n").collect()]
    assert got == [("three", ["1", "2", "3"], 3), ("two", ["1", "2"], 2), (None, ["8", "9"], 2)]
    whole = {r.TYP_DESC: r["values"] for r in q.dependency_map(
        df, "TYP_DESC", "RADIO_CODE").collect()}
    assert whole["one"] == ["1"] and whole["none"] == [] and len(whole) == 5
    rows = q.dependency_pairs(df, "TYP_DESC", "RADIO_CODE", "n").collect()
    assert {(r.TYP_DESC, r.RADIO_CODE, r.n) for r in rows} == {
        (key, code, n) for key, codes, n in got for code in codes}
    assert len(rows) == 7


def test_missing_and_duplicates(spark):
    df = pairs(spark, [(None, "1"), (" ", "1"), (" ", "1"), ("a", "2"), ("b", None), ("c", None)])
    got = {tuple(r) for r in q.missing_values(df, "TYP_DESC", ["RADIO_CODE", "TYP_DESC"]).collect()}
    assert got == {("1", None), ("1", " ")}
    assert {tuple(r) for r in q.duplicate_keys(df, "RADIO_CODE").collect()} == {
        ("1", 3), (None, 2)}


def test_ranges(spark):
    df = raw(spark, TYP_DESC=["ab", "abcd", None],
             CREATE_DATE=["12/31/2024", "01/01/2025", "2025-06-01"],
             INCIDENT_DATE=[None, None, None])
    assert q.max_length(df, "TYP_DESC").first()["max_TYP_DESC_len"] == 4
    row = q.date_range(df).first()
    assert (str(row.min_CREATE_DATE), str(row.max_CREATE_DATE)) == ("2024-12-31", "2025-01-01")
    assert row.min_INCIDENT_DATE is None


def test_time_status(spark):
    df = raw(
        spark, CAD_EVNT_ID=list("abcde"),
        INCIDENT_TIME=["25:61:00", " 9:05:06 ", "9:05", None, "23:59:59"],
        ADD_TS=["garbage", "7/4/2025 1:02:03 PM", None, "07/04/2025 01:02:03 PM", ""],
    )
    got = {r.CAD_EVNT_ID: r for r in q.time_status(df).collect()}
    assert [got[k].INCIDENT_TIME_status for k in "abcde"] == [
        "invalid", "ok", "invalid", "missing", "ok"]
    assert [got[k].ADD_TS_status for k in "abcde"] == [
        "invalid", "invalid", "missing", "ok", "invalid"]
    counts = {r.column_name: r.num_invalid for r in q.status_counts(df).collect()}
    assert counts == {"INCIDENT_TIME_status": 2, "ADD_TS_status": 3, "DISP_TS_status": 0,
                      "ARRIVD_TS_status": 0, "CLOSNG_TS_status": 0}


def test_late_incidents_and_order(spark):
    add = "01/05/2025 10:00:00 AM"
    df = raw(
        spark, CAD_EVNT_ID=list("abcd"), INCIDENT_DATE=["01/05/2025"] * 4,
        INCIDENT_TIME=["10:01:01", "10:01:00", "10:00:00", None],
        ADD_TS=[add, add, add, add],
        DISP_TS=["01/05/2025 09:59:59 AM", add, None, "garbage"],
    )
    assert [r.CAD_EVNT_ID for r in q.late_incidents(df).collect()] == ["a"]
    assert sorted(r.CAD_EVNT_ID for r in q.late_incidents(df, 0).collect()) == ["a", "b"]
    assert q.order_violations(df).first()[0] == 1
    got = {r.CAD_EVNT_ID: r.DISP_ADD_check for r in q.order_status(df).collect()}
    assert got == {"a": "DISP_before_ADD", "b": "ok", "c": "ok", "d": "ok"}


def test_order_status_does_not_trim(spark):
    df = raw(spark, INCIDENT_TIME=[" 9:05:06 ", "9:05:06", None])
    assert [r.INCIDENT_TIME_status for r in q.order_status(df).collect()] == [
        "invalid", "ok", "ok"]


def test_required_fields(spark):
    df = spark.createDataFrame(
        [("1", "garbage", None, "X", "10", "t"),
         (None, "01/05/2025 10:00:00 AM", "01/05/2025 10:00:00 AM", None, None, None)],
        "CAD_EVNT_ID string, ARRIVD_TS string, CLOSNG_TS string, PATRL_BORO_NM string, "
        "RADIO_CODE string, TYP_DESC string")
    first, second = sorted(q.required_status(df).collect(), key=lambda r: r.CAD_EVNT_ID is None)
    assert tuple(first)[1:] == ("ok", "missing", "missing", "ok", "ok", "ok")
    assert tuple(second)[1:] == ("missing", "ok", "ok", "missing", "missing", "missing")


def test_domain(spark):
    df = raw(spark, CAD_EVNT_ID=list("abc"), BORO_NM=["QUEENS", None, "JERSEY"])
    got = {r.CAD_EVNT_ID: r.BORO_NM_status for r in q.domain_status(df).collect()}
    assert got == {"a": "ok", "b": "ok", "c": "invalid"}
    assert {tuple(r) for r in q.domain_listing(df).collect()} == {
        ("QUEENS", 3), (None, 3), ("JERSEY", 3)}


def test_date_order(spark):
    df = raw(
        spark, CAD_EVNT_ID=list("abc"), CREATE_DATE=["01/05/2025"] * 3,
        INCIDENT_DATE=["01/04/2025", "01/06/2025", None],
        CLOSNG_TS=["01/05/2025 10:00:00 AM"] * 3,
    )
    got = {r.CAD_EVNT_ID: tuple(r)[1:] for r in q.date_order_status(df).collect()}
    assert got == {"a": ("before_CREATE_DATE", "ok"), "b": ("ok", "after_CLOSNG_TS"),
                   "c": ("ok", "ok")}
