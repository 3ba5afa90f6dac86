"""What filters drop, what a table looks like in one scan, and mergeable distinct counts."""

import pytest
from pyspark.sql import Observation, functions as F

from tests.test_quality import raw
from turnout import sources
from turnout.operators import ledger, overview, quality, sketches
from turnout.plans import catalog, clean, run_stages, scope
from turnout.plans.stages import clean_typed, type_calls


def as_dict(df):
    return {(r.stage, r.rule): r.num_rows for r in df.collect()}


def test_numbers_add_up(spark, small):
    typed = catalog.typed_calls(spark, small)
    rules = ledger.clean_rules()
    seen = Observation()
    kept = ledger.apply_rules(typed, rules, seen)
    rows = kept.count()
    found = as_dict(ledger.rejects(typed, rules, "clean"))
    assert found == {("clean", k): v for k, v in seen.get.items()}
    assert found["clean", "rows_out"] == rows
    assert found["clean", "rows_in"] - sum(found["clean", r] for r in rules) == rows
    assert all(found["clean", r] > 0 for r in rules)


def test_undecided_rows_are_dropped_and_counted(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "v int")
    rules = {"above_2": F.col("v") > 2, "below_9": F.col("v") < 9}
    assert [r.v for r in ledger.apply_rules(df, rules).collect()] == [5]
    assert as_dict(ledger.rejects(df, rules, "s")) == {
        ("s", "rows_in"): 3, ("s", "above_2"): 2, ("s", "below_9"): 0, ("s", "rows_out"): 1}
    assert as_dict(ledger.rejects(df.limit(0), rules, "s"))["s", "rows_in"] == 0


def test_observing_reads_nothing_twice(spark, small, tmp_path):
    catalog.raw_calls(spark, small).write.parquet(str(tmp_path / "raw"))
    typed = type_calls(spark.read.parquet(str(tmp_path / "raw")))
    codes = spark.createDataFrame([("x", 1)], "TYP_DESC string, code bigint")
    with_counts = clean_typed(typed, codes, seen=Observation())
    text = with_counts._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan parquet") == 1 and "CollectMetrics" in text


@pytest.mark.parametrize("row_stages, versions", [(True, False), (False, True)])
def test_a_run_leaves_its_ledger(spark, small, tmp_path, row_stages, versions):
    raw_rows = catalog.raw_calls(spark, small)
    root = str(tmp_path / "run")
    marts = run_stages(spark, raw_rows, root, row_stages=row_stages, versions=versions)
    read = sources.read_current if versions else sources.read_stage
    found = as_dict(read(spark, f"{root}/ledger"))
    cleaned = clean(raw_rows)
    assert found["dedup", "rows_in"] == raw_rows.count()
    assert found["dedup", "rows_out"] == found["clean", "rows_in"] == found["dedup", "rows_in"] - found["dedup", "most_complete"]
    assert found["clean", "rows_out"] == found["scope", "rows_in"] == cleaned.count()
    assert found["scope", "rows_out"] == scope(cleaned).count()
    assert marts["Part1/dfBoroughStats"].count() == 5


def test_overview_agrees_with_the_single_checks(spark, small):
    df = catalog.raw_calls(spark, small)
    seen = Observation()
    assert overview.profiled(df, seen, catalog.REGIONS).count() == df.count()
    found = {(r.check_name, r.column_name): r.value for r in overview.profile_raw(df, catalog.REGIONS).collect()}
    assert {f"{a} {b}": v for (a, b), v in found.items()} == {
        k: None if v is None else str(v) for k, v in seen.get.items()}
    assert found["rows", "*"] == str(df.count())
    assert found["late_by_60", "INCIDENT_TIME"] == str(quality.late_incidents(df, 60).count())
    invalid = {r.column_name: r.num_invalid for r in quality.status_counts(df).collect()}
    assert {f"{c}_status": int(found["invalid", c]) for c in quality.STATUS_COLUMNS} == invalid
    missing = quality.required_status(df, ["ARRIVD_TS"]).where("ARRIVD_TS_status = 'missing'").count()
    assert found["missing", "ARRIVD_TS"] == str(missing)


def test_overview_of_an_empty_and_an_all_null_table(spark):
    df = raw(spark, TYP_DESC=[None, " "])
    found = {(r.check_name, r.column_name): r.value for r in overview.profile_raw(df).collect()}
    assert (found["null", "TYP_DESC"], found["null_or_blank", "TYP_DESC"], found["rows", "*"]) == ("1", "2", "2")
    assert found["earliest", "CREATE_DATE"] is None and found["invalid", "ADD_TS"] == "0"
    empty = {(r.check_name, r.column_name): r.value for r in overview.profile_raw(df.limit(0)).collect()}
    assert empty["rows", "*"] == "0" and empty["missing", "ARRIVD_TS"] == "0"


def counts(sketch):
    return {r.column_name: r.num_distinct for r in sketches.estimates(sketch).collect()}


def test_sketches_of_halves_merge_to_the_whole(spark):
    df = spark.range(60_000).selectExpr(
        "if(id % 7 = 0, null, string(id % 50000)) as many", "string(id % 40) as few", "if(id < 3, 'x', null) as rare",
        "cast(null as string) as none")
    columns, pair = ["many", "few", "rare", "none"], ("few", "rare")
    halves = [sketches.distinct_sketches(df.where(f"id % 2 = {i}") if "id" in df.columns else df.where(
        f"pmod(hash(many, few), 2) = {i}"), columns, [pair]) for i in (0, 1)]
    whole = counts(sketches.distinct_sketches(df, columns, [pair]))
    parts = counts(sketches.merged(halves[0].unionByName(halves[1])))
    exact = {r.column_name: r.num_distinct for r in quality.distinct_counts(df, columns).collect()}
    exact["few, rare"] = quality.distinct_pair_count(df, *pair).first()[0]
    error = sketches.relative_error()
    assert error == pytest.approx(0.0081, abs=1e-4)
    for name, n in exact.items():
        assert abs(whole[name] - n) <= 3 * error * n and abs(parts[name] - n) <= 3 * error * n
        if n < 1000:
            assert whole[name] == parts[name] == n


def test_sketches_are_kept_beside_a_stage(spark, tmp_path):
    for day, start in (("a", 0), ("b", 600)):
        df = spark.range(start, start + 1000).selectExpr("string(id) as c")
        sources.write_stage(sketches.distinct_sketches(df, ["c"]), str(tmp_path / day))
    kept = spark.read.parquet(str(tmp_path / "a"), str(tmp_path / "b"))
    assert abs(counts(sketches.merged(kept))["c"] - 1600) <= 0.03 * 1600
