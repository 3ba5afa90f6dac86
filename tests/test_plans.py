"""What the physical plans look like."""

import re

import pytest
from pyspark.sql import functions as F

from turnout.operators import cleaning, encoding, numbering, overview, profiles, ranking
from turnout.plans import catalog


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def run_plan(df) -> str:
    df.collect()
    return plan(df)


def final_plan(df) -> str:
    """The plan that ran, in which exchanges of equal content are one."""
    return run_plan(df).split("Initial Plan")[0]


def test_dedup_limits_groups_before_the_shuffle(spark, small):
    text = plan(catalog.deduped_calls(spark, small))
    assert text.count("WindowGroupLimit") == 2
    last, first = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
    assert last < text.index("Exchange hashpartitioning(CAD_EVNT_ID") < first


def test_top_bottom_of_rows_limits_each_list_before_the_shuffle(spark, small):
    rows = catalog.line_calls(spark, small)
    text = plan(ranking.top_bottom_k(
        rows, ["CIP_JOBS"], "RESPONSE_TIME_SEC", ties=["BORO_NM", "NYPD_PCT_CD", "CAD_EVNT_ID"]
    ))
    assert text.count("WindowGroupLimit") == 4


def test_ranked_mart_counts_once(spark, small):
    calls = catalog.line_calls(spark, small)
    text = final_plan(ranking.precinct_ranked(calls))
    assert "Union" not in text and "ReusedExchange" in text
    # Two passes over the lines for exact medians; the other tables are read once.
    assert text.count("Scan parquet") == 6 + 1
    counts = profiles.response_counts(calls)
    assert final_plan(ranking.precinct_ranked(calls, counts=counts)).count("Scan parquet") == 6


def test_codes_are_numbered_without_a_single_partition(spark, tmp_path):
    spark.range(1000).select(F.col("id").cast("string").alias("TYP_DESC")).write.parquet(
        str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    text = plan(encoding.category_codes(df, "TYP_DESC", "dense_rank"))
    # Only the slice starts, of which there are at most 256, meet in one partition.
    for line in re.findall(r"Window \[row_number.*", text):
        assert re.search(r"\], \[_slice#\d+\], \[", line)
    for match in re.finditer(r"Exchange SinglePartition.*\n(.*)", text):
        assert "_slice" in match.group(1) or "collect_list" in match.group(1)


def test_dictionary_reuses_the_dedup_shuffle(spark, small):
    text = run_plan(catalog.cleaned_calls(spark, small))
    final = text[:text.rindex("== Initial Plan ==")]
    made = re.findall(r"(?<!, )Exchange hashpartitioning\(CAD_EVNT_ID", final.split("Initial Plan")[0])
    assert len(made) <= 1
    assert "ReusedExchange" in final


def test_stored_codes_are_broadcast_by_their_size(spark, small, tmp_path):
    deduped = catalog.deduped_calls(spark, small)
    deduped.write.parquet(str(tmp_path / "deduped"))
    stored = spark.read.parquet(str(tmp_path / "deduped"))
    encoding.category_codes(stored, "TYP_DESC").write.parquet(str(tmp_path / "codes"))
    codes = spark.read.parquet(str(tmp_path / "codes"))
    coded = encoding.encode_category(stored, codes=codes)
    assert "BroadcastHashJoin" in plan(coded) and "Exchange hash" not in plan(coded)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = encoding.encode_category(stored, codes=codes)
        assert "SortMergeJoin" in plan(shuffled)
        rows = sorted(map(str, shuffled.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert rows == sorted(map(str, coded.collect()))


def test_unused_codes_are_not_computed(spark, small):
    df = profiles.borough_profile(catalog.normalized_calls(spark, small))
    assert "_slice" not in plan(df)


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stage") / "normalized")
    catalog.normalized_calls(spark, small).write.parquet(path)
    return spark.read.parquet(path)


def test_profiles_read_only_their_columns(stored):
    text = plan(profiles.borough_profile(stored))
    assert re.search(r"ReadSchema: struct<BORO_NM:string,RESPONSE_TIME_SEC:bigint>", text)
    assert "PushedFilters: [IsNotNull(RESPONSE_TIME_SEC), GreaterThan(RESPONSE_TIME_SEC,0)]" in text


def test_counted_seconds_shuffle_by_group_and_second(stored):
    counts = profiles.response_counts(stored)
    text = final_plan(profiles.profile_of_counts(counts, ["BORO_NM"]))
    assert re.search(r"Exchange hashpartitioning\(BORO_NM#\d+, .*_seconds#\d+", text)
    assert text.count("Scan parquet") == 1 and "ReusedExchange" in text
    # Groups are put in order by buckets; single values only inside the buckets that a join picks.
    windows = re.findall(r"Window \[.*", text)
    assert any("_bucket#" in w for w in windows)
    values = [m.start() for m in re.finditer(r"Window \[[^\n]*\[_seconds#", text)]
    assert all("Join" in text[at:] for at in values)


def test_medians_of_rows_shuffle_by_group_alone(stored):
    text = final_plan(profiles.group_profile(stored.where(cleaning.positive()), ["BORO_NM"]))
    assert set(re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", text)) and "Window" not in text
    for keys in re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", text):
        assert re.fullmatch(r"(BORO_NM|_group|_of_group)#\d+", keys), keys
    assert "PushedFilters: [IsNotNull(RESPONSE_TIME_SEC), GreaterThan(RESPONSE_TIME_SEC,0)]" in text


def test_all_scalar_checks_are_one_scan(spark, small, tmp_path):
    catalog.raw_calls(spark, small).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    text = plan(overview.profile_raw(raw))
    assert text.count("Scan parquet") == 1 and text.count("Exchange") == 1
    assert text.count("HashAggregate") + text.count("SortAggregate") == 2


def test_a_hot_group_is_ranked_in_slices(spark):
    df = spark.range(20_000).selectExpr("if(id % 3 = 0, 'hot', string(id % 50)) as k", "id * 7919 % 4999 as v", "id")
    ranked = numbering.ranks_in_slices(df, ["k"], "v", ["id"], slices=16)
    text = final_plan(ranked)
    assert re.search(r"Exchange hashpartitioning\(k#\d+, _slice#\d+", text)
    assert not re.search(r"Window \[row_number[^\n]*\[k#\d+\]", text)


def test_top_k_does_not_sort_everything(stored):
    df = ranking.top_k(profiles.group_profile(stored, ["NYPD_PCT_CD"]), "avg_response_sec", 5)
    assert "TakeOrderedAndProject" in plan(df)
