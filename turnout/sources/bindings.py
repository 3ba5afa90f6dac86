"""Call tables derived from the star-schema tables, for checks and measurements.

``raw_calls`` is shaped like the raw text export.  Key, borough, precinct, type
and severity come from the tables; durations and a known share of defects
(missing, unreadable or misordered times, blank descriptions, bad boroughs,
duplicate and missing keys) follow from the event number, so that every row is
used and both engines of a comparison derive the same table.

``line_calls`` has one already-typed call per order line, for larger groups.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from turnout.schema import RAW_COLUMNS

# The columns in use; a given schema also saves reading a footer per table.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int",
    "part": "p_partkey bigint, p_type string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Nations and regions are fixed at 25 and 5 rows at every scale.
    region = F.broadcast(_read(spark, sf_dir, "region"))
    return _read(spark, sf_dir, "nation").join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )


def raw_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _read(spark, sf_dir, "customer")
    calls = (
        _read(spark, sf_dir, "events")
        .join(customer, F.col("user_id") == F.col("c_custkey"))
        .join(F.broadcast(_areas(spark, sf_dir)), F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "event_id as i",
            "date_trunc('second', ts) as added",
            "n_nationkey", "r_name", "event_type",
            "int(20 + (event_id * 7919) % 900) as dispatch_delay",
            "int(30 + (event_id * 104729) % 3600) as travel_time",
        )
        .selectExpr(
            "*",
            """case when i % 101 = 0 then added - interval 30 seconds
                    when i % 29 = 0 then null
                    else added + make_dt_interval(0, 0, 0, dispatch_delay) end as dispatched""",
            """case when i % 31 = 0 then null
                    when i % 89 = 0 then added - interval 300 seconds
                    when i % 211 = 0 then added + interval 90000 seconds
                    else added + make_dt_interval(0, 0, 0, dispatch_delay + travel_time)
               end as arrived""",
            """case when i % 67 = 0 then added + interval 120 seconds
                    else added - interval 10 seconds end as incident""",
        )
        # Some calls come a second time: poorer by three columns, or in another precinct.
        .selectExpr("*", """explode(array_compact(array(
            'first', if(i % 47 = 0, 'poorer', null), if(i % 63 = 0, 'moved', null)))) as copy""")
    )
    stamp = "date_format({}, 'MM/dd/yyyy hh:mm:ss a')"
    columns = {
        "CAD_EVNT_ID": "if(i % 997 = 0, null, string(i))",
        "CREATE_DATE": "date_format(added, 'MM/dd/yyyy')",
        "INCIDENT_DATE": "date_format(incident, 'MM/dd/yyyy')",
        "INCIDENT_TIME": """case when copy = 'poorer' then null when i % 59 = 0 then '25:61:00'
                                 else date_format(incident, 'HH:mm:ss') end""",
        "NYPD_PCT_CD": "if(copy = 'moved', '999', string(n_nationkey))",
        "BORO_NM": """case when i % 83 = 0 then '(null)' when i % 79 = 0 then null
                           else r_name end""",
        "RADIO_CODE": """concat(
            case event_type when 'signup' then '34' when 'purchase' then '31'
                            when 'view' then '10' when 'click' then '32' else '99' end,
            case i % 3 when 0 then 'S' when 1 then 'C' else 'N' end, '1')""",
        "TYP_DESC": """case when i % 41 = 0 then '  ' when i % 43 = 0 then null
                            when i % 37 = 0 then concat(event_type, ': alt')
                            else event_type end""",
        "CIP_JOBS": """case when copy = 'poorer' then null when i % 7 = 0 then 'Critical '
                            when i % 7 = 1 then 'Serious' when i % 7 = 2 then 'Non CIP'
                            else 'Non Critical' end""",
        "ADD_TS": f"if(i % 97 = 0, 'garbage', {stamp.format('added')})",
        "DISP_TS": stamp.format("dispatched"),
        "ARRIVD_TS": stamp.format("arrived"),
        "CLOSNG_TS": f"if(copy = 'poorer', null, {stamp.format('arrived')})",
    }
    return calls.selectExpr(*[f"{columns[c]} as {c}" for c in RAW_COLUMNS])


def patrol_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_calls`` with the patrol borough of the older export, missing in one call of 53."""
    raw = raw_calls(spark, sf_dir)
    patrol = "if(try_cast(CAD_EVNT_ID as bigint) % 53 = 0, null, concat('PATROL ', BORO_NM)) as PATRL_BORO_NM"
    return raw.selectExpr(*raw.columns[:6], patrol, *raw.columns[6:])


def line_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = (
        _read(spark, sf_dir, "lineitem")
        .join(_read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(_read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(F.broadcast(_areas(spark, sf_dir)), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return lines.selectExpr(
        "concat_ws('-', string(l_orderkey), string(l_linenumber)) as CAD_EVNT_ID",
        "n_nationkey as NYPD_PCT_CD",
        "r_name as BORO_NM",
        """case p_type when 'PROMO' then '34' when 'ECONOMY' then '31' when 'MEDIUM' then '10'
                       when 'SMALL' then '32' when 'STANDARD' then '30' else '99'
           end as RADIO_CODE""",
        """case o_orderpriority when '1-URGENT' then 'CRITICAL' when '2-HIGH' then 'SERIOUS'
                                when '3-MEDIUM' then 'NON CRITICAL' else 'NON CIP'
           end as CIP_JOBS""",
        """o_orderdate + make_dt_interval(0, 0, 0, int(
            (l_partkey * 7919 + l_suppkey * 104729 + l_linenumber * 3671) % 86400)) as ADD_TS""",
        "20 + (l_partkey * 31 + l_linenumber) % 900 as DISPATCH_DELAY_SEC",
        "30 + (l_suppkey * 7919 + l_orderkey) % 3600 as TRAVEL_TIME_SEC",
    ).selectExpr(
        "CAD_EVNT_ID", "NYPD_PCT_CD", "BORO_NM", "RADIO_CODE", "CIP_JOBS", "ADD_TS",
        "DISPATCH_DELAY_SEC + TRAVEL_TIME_SEC as RESPONSE_TIME_SEC",
        "DISPATCH_DELAY_SEC", "TRAVEL_TIME_SEC",
    )


def line_count(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the table of order lines, from which ``line_calls`` makes one call each."""
    return _read(spark, sf_dir, "lineitem").count()
