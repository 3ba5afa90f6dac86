"""Expressions on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from turnout import functions as fn


def values(spark, kind, inputs, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expression.alias("y")).orderBy("i").collect()]


def test_parse_date(spark):
    got = values(spark, "string", ["01/31/2025", "1/31/2025", "31/01/2025", "", None],
                 fn.parse_date("x"))
    assert got == [dt.date(2025, 1, 31), None, None, None, None]


def test_parse_ts_is_strict_and_never_raises(spark):
    got = values(spark, "string", [
        "07/04/2025 01:02:03 PM", "07/04/2025 12:00:00 AM", "garbage",
        "7/4/2025 1:02:03 PM", "07/04/2025 13:02:03", None,
    ], fn.parse_ts("x"))
    assert got == [
        dt.datetime(2025, 7, 4, 13, 2, 3), dt.datetime(2025, 7, 4), None, None, None, None,
    ]


@pytest.mark.parametrize("text, expected", [
    ("02/29/2024 12:00:00 AM", dt.datetime(2024, 2, 29)), ("02/29/2023 12:00:00 AM", None),
    ("04/31/2025 12:00:00 PM", None), ("04/30/2025 12:59:59 pm", dt.datetime(2025, 4, 30, 12, 59, 59)),
    ("03/09/2025 02:30:00 Am", dt.datetime(2025, 3, 9, 2, 30)), ("12/31/9999 11:59:59 PM", dt.datetime(9999, 12, 31, 23, 59, 59)),
    ("01/01/2025 00:10:00 AM", None), ("01/01/2025 13:00:00 PM", None), ("01/01/2025 11:60:00 AM", None),
    ("01/01/2025 11:59:60 PM", None), ("01/01/2025 11:59:59  PM", None), ("01/01/2025 11:59:59 XM", None),
    (" 01/01/2025 11:59:59 PM", None), ("01/01/2025 11:59:59 PM\n", None), ("01/01/12025 11:59:59 PM", None),
    ("+1/01/2025 11:59:59 PM", None), ("13/01/2025 11:59:59 PM", None), ("00/10/2025 11:59:59 PM", None),
])
def test_odd_stamps(spark, text, expected):
    df = spark.createDataFrame([(text, text[:10], text[11:19])], "x string, d string, t string")
    row = df.select(fn.parse_ts("x").alias("y"), fn.is_stamp_text("x").alias("ok"), fn.parse_date("d").alias("d")).first()
    assert (row.y, row.ok) == (expected, expected is not None)
    assert expected is None or row.d == expected.date()


def test_odd_times(spark):
    times = ["24:00:00", "9:05:06", "12:00:60", "12:60:00", " 12:00:00", "12:00:00\n", "12:00", "", None]
    assert values(spark, "string", times, fn.time_to_12h("x")) == [None] * 9
    assert values(spark, "string", times, fn.incident_ts(F.lit("01/05/2025"), "x")) == [None] * 9
    dates = ["02/30/2024", "01/01/2025\n", "1/1/2025", "2025-01-01"]
    assert values(spark, "string", dates, fn.incident_ts("x", F.lit("12:00:00"))) == [None] * 4


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("start, end, seconds", [
    # The night in March when New York has no 02:30, and the one in November when it has two.
    ("03/09/2025 01:30:00 AM", "03/09/2025 03:10:00 AM", 6000),
    ("03/09/2025 01:30:00 AM", "03/09/2025 02:10:00 AM", 2400),
    ("11/02/2025 12:30:00 AM", "11/02/2025 02:30:00 AM", 7200),
    ("11/02/2025 01:30:00 AM", "11/02/2025 01:10:00 AM", -1200),
])
def test_durations_are_those_of_the_clock_in_any_zone(spark, zone, start, end, seconds):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(start, end)], "a string, b string")
        row = df.select(
            fn.elapsed_seconds(fn.parse_ts("a"), fn.parse_ts("b")).alias("s"),
            fn.parse_ts("b").cast("string").alias("t"),
        ).first()
        assert row.s == seconds
        assert row.t[11:16] == dt.datetime.strptime(end, "%m/%d/%Y %I:%M:%S %p").strftime("%H:%M")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_incident_ts(spark):
    df = spark.createDataFrame(
        [("01/05/2025", "23:05:06"), ("01/05/2025", "25:61:00"), ("01/05/2025", None),
         (None, "23:05:06")], "d string, t string")
    got = [r.y for r in df.select(fn.incident_ts("d", "t").alias("y")).collect()]
    assert got == [dt.datetime(2025, 1, 5, 23, 5, 6), None, None, None]


@pytest.mark.parametrize("start, end, seconds, text, wrapped", [
    ("01/01/2025 12:00:00 AM", "01/02/2025 01:00:00 AM", 90000, "25:00:00", "01:00:00"),
    ("01/01/2025 12:00:05 AM", "01/01/2025 12:00:00 AM", -5, "-00:00:05", "23:59:55"),
    ("01/01/2025 12:00:00 AM", "01/01/2025 12:00:00 AM", 0, "00:00:00", "00:00:00"),
    ("01/01/2025 12:00:00 AM", "01/06/2025 04:00:00 AM", 446400, "124:00:00", "04:00:00"),
    ("garbage", "01/01/2025 12:00:00 AM", None, None, None),
    (None, "01/01/2025 12:00:00 AM", None, None, None),
])
def test_durations(spark, start, end, seconds, text, wrapped):
    df = spark.createDataFrame([(start, end)], "a string, b string")
    row = df.select(
        fn.elapsed_seconds(fn.parse_ts("a"), fn.parse_ts("b")).alias("s")
    ).select(
        "s", fn.format_hms("s").alias("t"), fn.format_hms("s", wrap24=True).alias("w")
    ).first()
    assert (row.s, row.t, row.w) == (seconds, text, wrapped)


def test_fractions_are_cut(spark):
    assert values(spark, "double", [725.9, -725.9, None], fn.format_hms("x")) == [
        "00:12:05", "-00:12:05", None,
    ]


def test_durations_do_not_depend_on_the_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(spark, "bigint", [725], fn.format_hms("x")) == ["00:12:05"]
        assert values(spark, "bigint", [725], fn.format_hms("x", wrap24=True)) == ["00:12:05"]
        assert values(spark, "string", ["23:05:06"], fn.time_to_12h("x")) == ["11:05:06 PM"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_hms_to_seconds(spark):
    got = values(spark, "string", ["01:02:03", "25:00:00", "-00:00:05", "01:02", "a:b:c", "", None],
                 fn.hms_to_seconds("x"))
    assert got == [3723, 90000, -5, None, None, None, None]


def test_text_and_seconds_are_inverse(spark):
    numbers = [-90061, -1, 0, 1, 59, 60, 3599, 3600, 86399, 86400, 999999]
    texts = values(spark, "bigint", numbers, fn.format_hms("x"))
    assert values(spark, "string", texts, fn.hms_to_seconds("x")) == numbers


def test_hms_to_minutes(spark):
    assert values(spark, "string", ["01:02:30", None], fn.hms_to_minutes("x")) == [62.5, None]


def test_add_seconds(spark):
    df = spark.createDataFrame([("00:01:00", "x")], "RESPONSE_TIME string, TRAVEL_TIME string")
    row = fn.add_seconds(df, ["RESPONSE_TIME", "TRAVEL_TIME"]).first()
    assert (row.RESPONSE_TIME_SEC, row.TRAVEL_TIME_SEC) == (60, None)


def test_time_to_12h(spark):
    got = values(spark, "string", ["23:05:06", "00:00:00", "12:30:00", "25:61:00", None],
                 fn.time_to_12h("x"))
    assert got == ["11:05:06 PM", "12:00:00 AM", "12:30:00 PM", None, None]


def test_text(spark):
    df = spark.createDataFrame([(" a b ", None)], "BORO_NM string, TYP_DESC string")
    row = fn.normalize_text(df, ["BORO_NM", "TYP_DESC"]).first()
    assert (row.BORO_NM, row.TYP_DESC) == ("A B", None)
    assert values(spark, "string", [None, "", "  ", "x"], fn.is_blank("x")) == [
        True, True, True, False,
    ]


def test_code_to_type(spark):
    codes = ["34S1", "99X", "3", None, "10H2"]
    got = values(spark, "string", codes, fn.map_code(fn.code_prefix("x")))
    assert got == ["ASSAULT (IN PROGRESS)", "UNKNOWN", "UNKNOWN", "UNKNOWN",
                   "INVESTIGATE/POSSIBLE CRIME"]
    assert values(spark, "string", codes, fn.map_code(fn.code_prefix("x"), {}, "NONE")) == [
        "NONE"] * 5


def test_pair_label(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(fn.pair_label("x", "y")).collect()] == ["a | b", None]


def test_calendar_parts(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2025, 1, 5, 0, 0, 1),), (dt.datetime(2025, 12, 31, 23, 59, 59),), (None,)],
        "ADD_TS timestamp")
    got = [tuple(r)[1:] for r in fn.calendar_parts(df).collect()]
    assert got == [(0, 1, "Sun"), (23, 12, "Wed"), (None, None, None)]


def test_null_count(spark):
    df = spark.createDataFrame([(1, None), (None, None), (1, 2)], "a int, b int")
    assert [r[0] for r in df.select(fn.null_count(df.columns)).collect()] == [1, 2, 0]
