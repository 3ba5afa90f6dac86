"""Files in and out, and the whole run."""

import os

import pytest

from turnout import sources
from turnout.plans import MART_NAMES, build_marts, clean, normalize, run_stages, scope
from turnout.plans.catalog import raw_calls
from turnout.schema import CLEANED, RAW, RAW_WITH_PATROL

HEADER = ",".join(RAW.names)


def rounded(df):
    """Rows as text; the last digits of deviations depend on the order of summing."""
    return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.collect())


def parquet_files(path):
    return [f for f in os.listdir(path) if f.endswith(".parquet")]


def test_raw_csv_keeps_malformed_lines(spark, tmp_path):
    full = "1,01/05/2025,01/05/2025,10:00:00,14,QUEENS,34S1,t,CRITICAL,a,b,c,d"
    (tmp_path / "raw.csv").write_text("\n".join([HEADER, full, "2,01/05/2025", full + ",x,y"]) + "\n")
    rows = sources.read_raw_csv(spark, str(tmp_path / "raw.csv")).collect()
    assert [r.CAD_EVNT_ID for r in rows] == ["1", "2", "1"]
    assert (rows[1].CREATE_DATE, rows[1].CLOSNG_TS) == ("01/05/2025", None)
    assert rows[2].CLOSNG_TS == "d"
    assert rows[0].NYPD_PCT_CD == "14"


def test_raw_csv_without_schema_or_with_inference(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("A,B\n1,x\n2,y\n")
    path = str(tmp_path / "raw.csv")
    assert sources.read_raw_csv(spark, path, schema=None).dtypes == [("A", "string"), ("B", "string")]
    assert sources.read_raw_csv(spark, path, infer=True).dtypes == [("A", "int"), ("B", "string")]


def test_csv_of_the_older_export(spark, tmp_path):
    line = "1,01/05/2025,01/05/2025,10:00:00,14,QUEENS,PATROL QUEENS,34S1,t,CRITICAL,a,b,c,d"
    (tmp_path / "raw.csv").write_text(",".join(RAW_WITH_PATROL.names) + "\n" + line + "\n")
    path = str(tmp_path / "raw.csv")
    for df in (sources.read_raw_csv(spark, path, RAW_WITH_PATROL), sources.read_raw_csv(spark, path)):
        row = df.first()
        assert (row.PATRL_BORO_NM, row.RADIO_CODE, row.CLOSNG_TS) == ("PATROL QUEENS", "34S1", "d")
    assert "PATRL_BORO_NM" not in sources.read_raw_csv(spark, path, extra="drop").columns


def test_csv_columns_land_by_name(spark, tmp_path):
    path = str(tmp_path / "raw.csv")
    (tmp_path / "raw.csv").write_text("BORO_NM, cad_evnt_id ,MORE,ADD_TS\nQUEENS,7,x,t\nBRONX\n")
    df = sources.read_raw_csv(spark, path)
    assert df.columns == [*RAW.names, "MORE"]
    rows = [(r.CAD_EVNT_ID, r.BORO_NM, r.ADD_TS, r.TYP_DESC, r.MORE) for r in df.collect()]
    assert rows == [("7", "QUEENS", "t", None, "x"), (None, "BRONX", None, None, None)]
    (tmp_path / "bad.csv").write_text("BORO_NM,ADD_TS\nQUEENS,t\n")
    with pytest.raises(ValueError, match="CAD_EVNT_ID"):
        sources.read_raw_csv(spark, str(tmp_path / "bad.csv"))


def test_csv_round_trip(spark, small, tmp_path):
    raw = raw_calls(spark, small)
    sources.write_csv(raw, str(tmp_path / "csv"))
    back = sources.read_raw_csv(spark, str(tmp_path / "csv"))
    # A blank description survives as text; null is written as nothing.
    assert sorted(map(str, back.collect())) == sorted(map(str, raw.collect()))


def test_stage_is_replaced_and_spread(spark, tmp_path):
    path = str(tmp_path / "stage")
    sources.write_stage(spark.range(100), path, files=5)
    assert len(parquet_files(path)) == 5
    sources.write_stage(spark.range(7), path)
    back = sources.read_stage(spark, path)
    assert back.count() == 7 and back.dtypes == [("id", "bigint")]


def test_preview(spark):
    mart = spark.range(10)
    assert sources.preview_mart(mart, n=3).count() == 3
    assert [r.id for r in sources.preview_mart(mart, "id", 2).collect()] == [9, 8]
    assert [r.id for r in sources.preview_mart(mart, "id", 2, ascending=True).collect()] == [0, 1]


def test_whole_run(spark, small, tmp_path):
    raw = raw_calls(spark, small)
    marts = run_stages(spark, raw, str(tmp_path), files=3)
    assert tuple(marts) == MART_NAMES
    direct = normalize(scope(clean(raw)))
    stored = sources.read_stage(spark, f"{tmp_path}/normalized")
    assert stored.dtypes == [(f.name, f.dataType.simpleString()) for f in CLEANED.fields]
    assert sorted(map(str, stored.collect())) == sorted(map(str, direct.collect()))
    assert len(parquet_files(f"{tmp_path}/cleaned")) == 3
    for name, mart in build_marts(stored).items():
        assert rounded(marts[name]) == rounded(mart)
    lean = run_stages(spark, raw, str(tmp_path / "lean"), row_stages=False, accuracy=1_000_000, k=3)
    assert not (tmp_path / "lean" / "normalized").exists()
    name = "Part1/dfBoroughStats"
    assert rounded(lean[name]) == rounded(marts[name])
    # Stored marts can still be ordered by seconds.
    top = sources.preview_mart(marts["Part1/dfPrecinctStats"], "AVG_RESPONSE_SEC")
    assert top.count() == 5


def test_lines_with_too_many_or_too_few_fields_are_rescued(spark, tmp_path):
    full = "1,01/05/2025,01/05/2025,10:00:00,14,QUEENS,34S1,t,CRITICAL,a,b,c,d"
    lines = [full, "2,01/05/2025", full + ",x,y", '3,"a, ""b""",' + ",".join("cdefghijk")]
    (tmp_path / "raw.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    path = str(tmp_path / "raw.csv")
    plain, df = sources.read_raw_csv(spark, path), sources.read_raw_csv(spark, path, rescued="_line")
    assert df.columns == [*plain.columns, "_line"]
    assert [r[:-1] for r in df.collect()] == [tuple(r) for r in plain.collect()]
    assert [r._line for r in df.collect()] == [None, *lines[1:]]
    assert df.where("_line is not null").count() == 3
    assert df.select("_line").where("_line like '%,x,y'").count() == 1
    assert df.select("CAD_EVNT_ID").collect() == plain.select("CAD_EVNT_ID").collect()
    bare = sources.read_raw_csv(spark, path, schema=None, rescued="_line")
    assert bare.columns == [*HEADER.split(","), "_line"] and bare.where("_line is not null").count() == 3


def test_versions_of_a_stage(spark, tmp_path):
    path = str(tmp_path / "stage")
    with pytest.raises(FileNotFoundError):
        sources.read_current(spark, path)
    sources.replace_stage(spark.range(10), path)
    sources.replace_stage(sources.read_current(spark, path).where("id >= 4"), path, files=1)  # from itself
    assert sources.read_current(spark, path).count() == 6
    assert sources.read_current(spark, path, 1).count() == 10
    assert [r.number for r in sources.stage_versions(spark, path).orderBy("number").collect()] == [1, 2]
    broken = spark.range(4).selectExpr("if(id = 3, raise_error('half-way'), id) as id")
    with pytest.raises(Exception, match="half-way"):
        sources.replace_stage(broken, path)
    assert sources.read_current(spark, path).count() == 6
    with pytest.raises(FileNotFoundError):
        sources.read_current(spark, path, 9)
