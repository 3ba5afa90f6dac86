"""Profiles, rankings and chart tables on hand-made rows."""

import datetime as dt
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from turnout.operators import charts as c, profiles as p, ranking as r
from turnout.sources.bindings import line_calls

CALLS = ("BORO_NM string, NYPD_PCT_CD int, RADIO_CODE string, TYP_DESC_ENUM bigint, "
         "CIP_JOBS string, ADD_TS timestamp, RESPONSE_TIME_SEC bigint, "
         "DISPATCH_DELAY_SEC bigint, TRAVEL_TIME_SEC bigint")


def calls(spark, rows):
    """Rows of (borough, precinct, code, severity, hour, response, dispatch, travel)."""
    return spark.createDataFrame([
        (b, n, code, 1, sev, dt.datetime(2025, 1, 5, hour), resp, disp, trav)
        for b, n, code, sev, hour, resp, disp, trav in rows
    ], CALLS)


@pytest.fixture(scope="module")
def sample(spark):
    return calls(spark, [
        ("Q", 1, "34S1", "CRITICAL", 0, 100, 40, 60),
        ("Q", 1, "34S2", "CRITICAL", 23, 201, 41, 160),
        ("Q", 2, "34S1", "SERIOUS", 0, 400, None, None),
        ("B", 3, "99X", "NON CRITICAL", 5, 725, 25, 700),
        ("B", 3, None, None, 5, 726, 0, 726),
        ("B", 3, "10", "OTHER", 5, None, 7, None),
        ("B", 3, "10", "OTHER", 5, -5, 7, -12),
        ("B", 3, "10", "OTHER", 5, 0, 7, 1),
    ])


def test_borough_profile(sample):
    got = [tuple(x) for x in p.borough_profile(sample).collect()]
    assert [x[0] for x in got] == ["B", "Q"]                   # slowest first
    name, avg, median, stddev, count, avg_text, median_text, stddev_text = got[1]
    assert (avg, median, count) == ((100 + 201 + 400) / 3, 201, 3)
    assert stddev == pytest.approx(statistics.stdev([100, 201, 400]))
    assert (avg_text, median_text, stddev_text) == ("00:03:53", "00:03:21", "00:02:32")
    assert got[0][5] == "00:12:05"                             # 725.5 is cut


def test_one_row_has_no_deviation(sample):
    row = p.precinct_profile(sample).where("NYPD_PCT_CD = 2").first()
    assert (row.STDDEV_RESPONSE_SEC, row.STDDEV_RESPONSE_TIME) == (None, None)
    assert row.NUM_RECORDS == 1


@pytest.mark.parametrize("accuracy", [None, 10000])
def test_profile_of_several_columns(spark, accuracy):
    df = calls(spark, [
        ("Q", 1, "34", "A", 0, 10, None, 1), ("Q", 1, "34", "A", 0, 20, None, 2),
        ("Q", 1, "34", "A", 0, 40, 5, None), (None, 1, "34", "A", 0, 7, 7, 7),
    ])
    stats = ("avg", "median", "stddev", "min", "max")
    got = {x.BORO_NM: x for x in p.group_profile(
        df, ["BORO_NM"], p.ALL_METRICS, stats, accuracy=accuracy).collect()}
    q = got["Q"]
    assert (q.num_records, q.median_response_sec, q.median_dispatch_sec, q.median_travel_sec) == (
        3, 20, 5, 1)
    assert q.avg_response_sec == pytest.approx(70 / 3)
    assert q.stddev_response_sec == pytest.approx(statistics.stdev([10, 20, 40]))
    assert (q.stddev_dispatch_sec, q.min_travel_sec, q.max_travel_sec) == (None, 1, 2)
    assert got[None].num_records == 1


def test_group_without_any_value(spark):
    df = calls(spark, [("Q", 1, "34", "A", 0, None, None, None)])
    row = p.group_profile(df, ["BORO_NM"]).first()
    assert (row.avg_response_sec, row.median_response_sec, row.stddev_response_sec) == (
        None, None, None)
    assert row.num_records == 1


def test_exact_median_of_a_group_with_most_rows(spark):
    # 90,000 rows in one group and many distinct values: more than an
    # approximate median of default accuracy resolves.
    df = spark.range(100000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("BORO_NM"),
        (F.col("id") * 7919 % 50021).alias("RESPONSE_TIME_SEC"))
    values = {"hot": [], "cold": []}
    for i in range(100000):
        values["hot" if i % 10 < 9 else "cold"].append(i * 7919 % 50021)
    got = {x.BORO_NM: x for x in p.group_profile(df, ["BORO_NM"]).collect()}
    for name, numbers in values.items():
        assert got[name].median_response_sec == statistics.median_low(numbers)
        assert got[name].avg_response_sec == pytest.approx(statistics.fmean(numbers), rel=1e-12)
        assert got[name].stddev_response_sec == pytest.approx(
            statistics.stdev(numbers), rel=1e-9)
        assert got[name].num_records == len(numbers)


def test_counts_sum_to_the_filtered_total(sample):
    total = sample.where("RESPONSE_TIME_SEC > 0").count()
    assert p.borough_profile(sample).agg(F.sum("NUM_RECORDS")).first()[0] == total
    assert p.borough_detail(sample).agg(F.sum("INCIDENT_COUNT")).first()[0] == total


def test_detail(sample):
    df = p.borough_detail(sample)
    assert df.columns == [
        "BORO_NM", "RADIO_CODE_PREFIX", "TYP_DESC", "CIP_JOBS", "AVG_RESPONSE_SEC",
        "MEDIAN_RESPONSE_SEC", "MIN_RESPONSE_SEC", "MAX_RESPONSE_SEC", "INCIDENT_COUNT",
        "AVG_RESPONSE_TIME", "MEDIAN_RESPONSE_TIME", "MIN_RESPONSE_TIME", "MAX_RESPONSE_TIME",
    ]
    rows = df.collect()
    top = rows[0]
    assert (top.BORO_NM, top.TYP_DESC, top.CIP_JOBS, top.INCIDENT_COUNT) == (
        "Q", "ASSAULT (IN PROGRESS)", "CRITICAL", 2)
    assert (top.MIN_RESPONSE_TIME, top.MAX_RESPONSE_TIME) == ("00:01:40", "00:03:21")
    assert {x.TYP_DESC for x in rows if x.BORO_NM == "B"} == {"UNKNOWN"}
    assert "NYPD_PCT_CD" in p.precinct_detail(sample).columns


def test_severity_profile(sample):
    rows = p.severity_profile(sample).collect()
    assert [x.CIP_JOBS for x in rows] == ["CRITICAL", "SERIOUS", "NON CRITICAL"]
    assert (rows[0].avg_response_time, rows[0].median_dispatch_time) == ("00:02:30", "00:00:40")
    assert (rows[1].avg_travel_sec, rows[1].avg_travel_time) == (None, None)


def test_other_metrics_have_their_own_filter(sample):
    got = {x.BORO_NM: x.num_records for x in p.dispatch_profile(sample, ["BORO_NM"]).collect()}
    assert got == {"Q": 2, "B": 4}
    got = {x.BORO_NM: x.num_records for x in p.travel_profile(sample, ["BORO_NM"]).collect()}
    assert got == {"Q": 2, "B": 3}


def test_hours(sample):
    rows = p.hourly_profile(sample, "high_severity").collect()
    assert [(x.hour_of_day, x.num_records) for x in rows] == [(0, 2), (23, 1)]
    assert rows[0].avg_dispatch_delay_time == "00:00:40"
    assert p.hourly_profile(sample, "non_critical").count() == 1
    short = p.hourly_profile(sample, "non_critical", {"response": p.RESPONSE})
    assert short.columns == [
        "hour_of_day", "avg_response_sec", "num_records", "avg_response_time"]
    assert [x.hour_of_day for x in p.calendar_profile(sample, "hour_of_day").collect()] == [
        0, 5, 23]
    assert p.calendar_profile(sample, "day_of_week").first().day_of_week == "Sun"
    assert p.calendar_profile(sample, "month").first().month == 1
    assert p.hour_cross_profile(sample, "CIP_JOBS").count() == 4
    assert p.hour_cross_profile(sample, "BORO_NM").count() == 3


def test_whole_columns(sample):
    known = [100, 201, 400, 725, 726, -5, 0]
    assert p.means(sample).first().RESPONSE_TIME_mean_sec == pytest.approx(sum(known) / 7)
    assert p.medians(sample).first().RESPONSE_TIME_median_sec == 201
    assert p.medians(sample, accuracy=1000).first().RESPONSE_TIME_median_sec == 201
    assert p.stddevs(sample).first().RESPONSE_TIME_stddev_sec == pytest.approx(
        statistics.stdev(known))


def test_modes(spark):
    df = spark.createDataFrame(
        [(None, 10), (None, 9), ("a", 9), ("b", 10)], "x string, y bigint")
    got = {m.column_name: (m["mode"], m.num_records) for m in p.modes(df, ["x", "y"]).collect()}
    assert got == {"x": (None, 2), "y": ("9", 2)}     # ties go by number, not by text


# --- ranking --------------------------------------------------------------

def groups(spark, sizes):
    return spark.createDataFrame([
        ("B", n, "34", t, "S", float(n)) for t, size in sizes.items() for n in range(1, size + 1)
    ], "BORO_NM string, NYPD_PCT_CD int, RADIO_CODE_PREFIX string, TYP_DESC string, "
       "CIP_JOBS string, AVG_RESPONSE_SEC double")


def test_ranks_are_permutations(spark):
    rows = r.rank_groups(groups(spark, {"t": 12, "u": 3})).collect()
    for t, size in (("t", 12), ("u", 3)):
        some = [x for x in rows if x.TYP_DESC == t]
        assert sorted(x.RANK_FAST for x in some) == list(range(1, size + 1))
        assert all(x.RANK_FAST + x.RANK_SLOW == size + 1 for x in some)


def test_a_small_group_is_in_both_lists(spark):
    rows = r.top_bottom_k(groups(spark, {"t": 12, "u": 3})).collect()
    of = lambda t, kind: [x.NYPD_PCT_CD for x in rows if (x.TYP_DESC, x.GROUP_TYPE) == (t, kind)]
    assert of("t", "TOP_5_FASTEST") == [1, 2, 3, 4, 5]
    assert of("t", "BOTTOM_5_SLOWEST") == [8, 9, 10, 11, 12]
    assert of("u", "TOP_5_FASTEST") == of("u", "BOTTOM_5_SLOWEST") == [1, 2, 3]


def test_ties_go_by_area(spark):
    df = groups(spark, {"t": 4}).withColumn("AVG_RESPONSE_SEC", F.lit(1.0))
    rows = r.top_bottom_k(df, k=2).collect()
    assert [(x.GROUP_ORDER, x.NYPD_PCT_CD) for x in rows] == [(0, 1), (0, 2), (1, 1), (1, 2)]


def test_top_k(spark):
    df = groups(spark, {"t": 12})
    assert [x.NYPD_PCT_CD for x in r.top_k(df, "AVG_RESPONSE_SEC", 2).collect()] == [12, 11]
    assert [x.NYPD_PCT_CD for x in r.top_k(df, "AVG_RESPONSE_SEC", 2, True).collect()] == [1, 2]


# --- chart tables ---------------------------------------------------------

def test_pair_matrix_keeps_unlisted_boroughs(spark):
    mart = spark.createDataFrame([
        ("Q", "t", "CRITICAL", "00:02:00"), ("E", "t", "CRITICAL", "00:04:00"),
        (None, "t", "CRITICAL", "00:08:00"), ("E", "u", "CRITICAL", "00:01:00"),
    ], "BORO_NM string, TYP_DESC string, CIP_JOBS string, AVG_RESPONSE_TIME string")
    assert [tuple(x) for x in c.chart_pair_matrix(mart, ["Q"]).collect()] == [
        ("t | CRITICAL", 0, 2.0, 6.0), ("u | CRITICAL", 0, None, 1.0),
    ]
    assert [tuple(x) for x in c.chart_pair_cells(mart).collect()] == [
        ("t | CRITICAL", 0, "E", 4.0), ("t | CRITICAL", 0, "Q", 2.0), ("t | CRITICAL", 0, None, 8.0),
        ("u | CRITICAL", 0, "E", 1.0),
    ]


def test_tags_and_colours_follow_k(spark, small):
    mart = r.precinct_ranked(line_calls(spark, small), k=3)
    assert {x.GROUP_TYPE for x in mart.select("GROUP_TYPE").distinct().collect()} == {
        "TOP_3_FASTEST", "BOTTOM_3_SLOWEST",
    }
    assert {x.COLOUR for x in c.chart_ranked_facets(mart).select("COLOUR").distinct().collect()} == {
        "green", "red",
    }


def test_listings_are_ordered(spark, small):
    rows = p.borough_listing(line_calls(spark, small), "type").collect()
    keys = [(x.TYP_DESC, x.CIP_JOBS, -x.AVG_RESPONSE_SEC) for x in rows]
    assert keys == sorted(keys)
    rows = p.borough_listing(line_calls(spark, small), "borough").collect()
    keys = [(x.BORO_NM, -x.AVG_RESPONSE_SEC) for x in rows]
    assert keys == sorted(keys)


def test_pair_matrix(spark):
    mart = spark.createDataFrame([
        ("Q", "t", "NON CRITICAL", "00:01:00"), ("Q", "t", "CRITICAL", "00:02:00"),
        ("B", "t", "CRITICAL", "00:04:00"), ("B", "t", "CRITICAL", "00:05:00"),
        ("Q", "s", "OTHER", "00:03:00"), ("Q", "t", None, "00:09:00"),
    ], "BORO_NM string, TYP_DESC string, CIP_JOBS string, AVG_RESPONSE_TIME string")
    rows = [tuple(x) for x in c.chart_pair_matrix(mart, ["B", "Q"]).collect()]
    assert rows == [
        ("t | CRITICAL", 0, 4.5, 2.0, None), ("t | NON CRITICAL", 2, None, 1.0, None),
        ("s | OTHER", 3, None, 3.0, None),
    ]


def test_chart_tables(sample):
    got = {x.BORO_NM: (x.AVG_MIN, x.NUM_RECORDS)
           for x in c.chart_borough(p.borough_profile(sample)).collect()}
    assert got == {"B": (725 / 60, 2), "Q": (233 / 60, 3)}
    assert c.chart_precinct_points(p.precinct_profile(sample)).count() == 3
    stack = c.chart_severity_stack(p.severity_profile(sample)).first()
    assert stack.TRAVEL_BASE_MIN == stack.DISPATCH_MIN == 40 / 60
    assert c.chart_severity(p.severity_profile(sample)).first().AVG_MIN == 2.5
    hourly = c.chart_hourly(p.hourly_profile(sample, "non_critical")).first()
    assert (hourly.hour_of_day, hourly.TRAVEL_MIN, hourly.num_records) == (5, 700 / 60, 1)


def test_ranked_facets(sample):
    mart = r.precinct_ranked(sample)
    facets = c.chart_facets(mart).collect()
    assert {x.TITLE for x in facets} == {
        "ASSAULT (IN PROGRESS) (CRITICAL)", "ASSAULT (IN PROGRESS) (SERIOUS)",
        "UNKNOWN (NON CRITICAL)"}
    bars = c.chart_ranked_facets(mart).collect()
    assert len(bars) == 6 and {x.COLOUR for x in bars} == {"green", "red"}
    assert {x.PRECINCT for x in bars} == {"1", "2", "3"}


def test_exact_medians_against_plain_ones(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "a", "a", None, "b"]), rng.choice([None, 1, 2]),
             rng.choice([None, rng.randrange(-50, 50), int(rng.lognormvariate(6, 2)), 7])) for _ in range(6000)]
    rows += [("one", 1, 5), ("two", 1, 9), ("two", 1, 3), ("none", 1, None), ("same", 1, 4), ("same", 1, 4)]
    df = spark.createDataFrame(rows, "k string, g int, v bigint").repartition(7)
    got = {(r.k, r.g): r for r in p.group_profile(
        df, ["k", "g"], {"v": "v"}, ("median", "avg", "min", "max")).collect()}
    groups = {}
    for k, g, v in rows:
        groups.setdefault((k, g), []).append(v)
    assert set(got) == set(groups)
    for key, all_values in groups.items():
        known = [v for v in all_values if v is not None]
        row = got[key]
        assert row.num_records == len(all_values)
        expected = (statistics.median_low(known), min(known), max(known)) if known else (None,) * 3
        assert (row.median_v_sec, row.min_v_sec, row.max_v_sec) == expected


def test_medians_shuffle_by_group_only(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as v")
    profile = p.group_profile(df, ["k"], {"v": "v"})
    profile.collect()
    plan = profile._jdf.queryExecution().executedPlan().toString()
    keys = set(re.findall(r"hashpartitioning\(([^)]*)\)", plan))
    assert keys and not any("_v" in k.split(", ") or "seconds" in k for k in keys)
    assert "Window" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_broken_sketch_is_an_error_and_not_a_wrong_median(spark, monkeypatch):
    monkeypatch.setattr(p, "MARGIN", -0.4)  # bounds the wrong way round
    df = spark.range(100).selectExpr("1 as k", "id as v")
    with pytest.raises(Exception, match="outside the bounds"):
        p.group_profile(df, ["k"], {"v": "v"}).collect()
