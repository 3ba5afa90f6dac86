"""The same queries as plain SQL for a second engine (DuckDB dialect).

Written apart from the library: nothing here is imported from it.  Each
statement is a chain of common table expressions up to the stage it needs.
"""

# --- stages ---------------------------------------------------------------

STAMP = "%m/%d/%Y %I:%M:%S %p"
RAW = (
    "CAD_EVNT_ID, CREATE_DATE, INCIDENT_DATE, INCIDENT_TIME, NYPD_PCT_CD, BORO_NM, RADIO_CODE, "
    "TYP_DESC, CIP_JOBS, ADD_TS, DISP_TS, ARRIVD_TS, CLOSNG_TS"
)
RAW_LIST = RAW.split(", ")

EVENTS = """
e as (
 select ev.event_id as i, date_trunc('second', ev.ts) as a, n.n_nationkey as pct,
  r.r_name as boro, ev.event_type as et,
  cast(20 + (ev.event_id * 7919) % 900 as int) as dd,
  cast(30 + (ev.event_id * 104729) % 3600 as int) as tt
 from events ev join customer cu on ev.user_id = cu.c_custkey
 join nation n on cu.c_nationkey = n.n_nationkey
 join region r on n.n_regionkey = r.r_regionkey),
t as (select *,
  case when i % 101 = 0 then a + to_seconds(-30) when i % 29 = 0 then null
   else a + to_seconds(dd) end as d,
  case when i % 31 = 0 then null when i % 89 = 0 then a + to_seconds(-300)
   when i % 211 = 0 then a + to_seconds(90000) else a + to_seconds(dd + tt) end as r,
  case when i % 67 = 0 then a + to_seconds(120) else a + to_seconds(-10) end as inc from e),
b as (select i, case when i % 997 = 0 then null else cast(i as varchar) end as CAD_EVNT_ID,
 strftime(a, '%m/%d/%Y') as CREATE_DATE, strftime(inc, '%m/%d/%Y') as INCIDENT_DATE,
 case when i % 59 = 0 then '25:61:00' else strftime(inc, '%H:%M:%S') end as INCIDENT_TIME,
 cast(pct as varchar) as NYPD_PCT_CD,
 case when i % 83 = 0 then '(null)' when i % 79 = 0 then null else boro end as BORO_NM,
 case et when 'signup' then '34' when 'purchase' then '31' when 'view' then '10'
  when 'click' then '32' else '99' end
  || case i % 3 when 0 then 'S' when 1 then 'C' else 'N' end || '1' as RADIO_CODE,
 case when i % 41 = 0 then '  ' when i % 43 = 0 then null when i % 37 = 0 then et || ': alt'
  else et end as TYP_DESC,
 case i % 7 when 0 then 'Critical ' when 1 then 'Serious' when 2 then 'Non CIP'
  else 'Non Critical' end as CIP_JOBS,
 case when i % 97 = 0 then 'garbage' else strftime(a, '{stamp}') end as ADD_TS,
 strftime(d, '{stamp}') as DISP_TS, strftime(r, '{stamp}') as ARRIVD_TS,
 strftime(r, '{stamp}') as CLOSNG_TS from t),
raw as (
 select {raw} from b
 union all
 select CAD_EVNT_ID, CREATE_DATE, INCIDENT_DATE, null, NYPD_PCT_CD, BORO_NM, RADIO_CODE,
  TYP_DESC, null, ADD_TS, DISP_TS, ARRIVD_TS, null from b where i % 47 = 0
 union all
 select CAD_EVNT_ID, CREATE_DATE, INCIDENT_DATE, INCIDENT_TIME, '999', BORO_NM, RADIO_CODE,
  TYP_DESC, CIP_JOBS, ADD_TS, DISP_TS, ARRIVD_TS, CLOSNG_TS from b where i % 63 = 0)
""".replace("{stamp}", STAMP).replace("{raw}", RAW)


def dedup(source: str, columns, key: str = "CAD_EVNT_ID") -> str:
    nulls = " + ".join(f"({c} is null)::int" for c in columns)
    ties = ", ".join(f"{c} asc nulls last" for c in columns if c != key)
    return (
        f"select {', '.join(columns)} from (select *, row_number() over (partition by {key} "
        f"order by {nulls}, {ties}) as rn from {source}) where rn = 1"
    )


def ts(c: str) -> str:
    return f"try_strptime({c}, '{STAMP}')"


def date(c: str) -> str:
    return f"cast(try_strptime({c}, '%m/%d/%Y') as date)"


def gap(start: str, end: str) -> str:
    return f"cast(epoch({end}) - epoch({start}) as bigint)"


def hms(value: str) -> str:
    whole = f"cast(trunc({value}) as bigint)"
    size = f"abs({whole})"
    return (
        f"case when {value} is null then null else (case when {whole} < 0 then '-' else '' end) "
        f"|| printf('%02d:%02d:%02d', {size} // 3600, ({size} % 3600) // 60, {size} % 60) end"
    )


def hms_wrapped(value: str) -> str:
    day = f"((({value}) % 86400 + 86400) % 86400)"
    return (
        f"case when {value} is null then null else "
        f"printf('%02d:%02d:%02d', {day} // 3600, ({day} % 3600) // 60, {day} % 60) end"
    )


DURATIONS = {
    "RESPONSE_TIME": ("ADD_TS", "ARRIVD_TS"),
    "DISPATCH_DELAY": ("ADD_TS", "DISP_TS"),
    "TRAVEL_TIME": ("DISP_TS", "ARRIVD_TS"),
}

DEDUPED = f"deduped as ({dedup('raw', RAW_LIST)})"

STAMPED = f"""
stamped as (select CAD_EVNT_ID, {date('CREATE_DATE')} as CREATE_DATE,
 {date('INCIDENT_DATE')} as INCIDENT_DATE, INCIDENT_TIME,
 try_cast(NYPD_PCT_CD as integer) as NYPD_PCT_CD, BORO_NM, RADIO_CODE, TYP_DESC, CIP_JOBS,
 {ts('ADD_TS')} as ADD_TS, {ts('DISP_TS')} as DISP_TS, {ts('ARRIVD_TS')} as ARRIVD_TS,
 {ts('CLOSNG_TS')} as CLOSNG_TS,
 try_strptime(concat_ws(' ', INCIDENT_DATE, INCIDENT_TIME), '%m/%d/%Y %H:%M:%S') as INCIDENT_TS
 from deduped),
timed as (select *, {', '.join(f"{gap(s, e)} as {n}_SEC" for n, (s, e) in DURATIONS.items())}
 from stamped),
typed as (select *, {', '.join(f"{hms(n + '_SEC')} as {n}" for n in DURATIONS)} from timed)
"""

CODED = """
codes as (select v, cast(row_number() over (order by v) - 1 as bigint) as code
 from (select distinct TYP_DESC as v from deduped where TYP_DESC is not null)),
coded as (select typed.*, coalesce(code, -1) as TYP_DESC_ENUM
 from typed left join codes on TYP_DESC = v)
"""

CLEAN_COLUMNS = (
    "CAD_EVNT_ID, CREATE_DATE, INCIDENT_DATE, INCIDENT_TIME, NYPD_PCT_CD, BORO_NM, RADIO_CODE, "
    "TYP_DESC, TYP_DESC_ENUM, CIP_JOBS, ADD_TS, DISP_TS, ARRIVD_TS, CLOSNG_TS, RESPONSE_TIME, "
    "DISPATCH_DELAY, TRAVEL_TIME, RESPONSE_TIME_SEC, DISPATCH_DELAY_SEC, TRAVEL_TIME_SEC"
)

GOOD_BOROUGH = "BORO_NM is not null and trim(BORO_NM) <> '(null)'"
GOOD_DISPATCH = "(DISP_TS is null or ADD_TS is null or DISP_TS >= ADD_TS)"
GOOD_INCIDENT = (
    f"(INCIDENT_TS is null or ADD_TS is null or {gap('ADD_TS', 'INCIDENT_TS')} <= 60)"
)

CLEANED = f"""
cleaned as (select {CLEAN_COLUMNS} from coded
 where {GOOD_BOROUGH} and {GOOD_DISPATCH} and {GOOD_INCIDENT})
"""

IN_SCOPE = "coalesce(upper(trim(CIP_JOBS)) in ('CRITICAL', 'SERIOUS', 'NON CRITICAL'), false)"

SCOPED = """
scoped as (select * from cleaned
 where upper(trim(CIP_JOBS)) in ('CRITICAL', 'SERIOUS', 'NON CRITICAL')
 and RESPONSE_TIME_SEC > 90)
"""

NORMALIZED = """
normalized as (select * replace (
  strftime(try_strptime(INCIDENT_TIME, '%H:%M:%S'), '%I:%M:%S %p') as INCIDENT_TIME,
  upper(trim(BORO_NM)) as BORO_NM, upper(trim(RADIO_CODE)) as RADIO_CODE,
  upper(trim(TYP_DESC)) as TYP_DESC, upper(trim(CIP_JOBS)) as CIP_JOBS) from scoped)
"""

LINES = """
lines as (select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as CAD_EVNT_ID,
 n_nationkey as NYPD_PCT_CD, r_name as BORO_NM,
 case p_type when 'PROMO' then '34' when 'ECONOMY' then '31' when 'MEDIUM' then '10'
  when 'SMALL' then '32' when 'STANDARD' then '30' else '99' end as RADIO_CODE,
 case o_orderpriority when '1-URGENT' then 'CRITICAL' when '2-HIGH' then 'SERIOUS'
  when '3-MEDIUM' then 'NON CRITICAL' else 'NON CIP' end as CIP_JOBS,
 o_orderdate + to_seconds((l_partkey * 7919 + l_suppkey * 104729 + l_linenumber * 3671) % 86400)
  as ADD_TS,
 cast(20 + (l_partkey * 31 + l_linenumber) % 900 + 30 + (l_suppkey * 7919 + l_orderkey) % 3600
  as bigint) as RESPONSE_TIME_SEC,
 cast(20 + (l_partkey * 31 + l_linenumber) % 900 as bigint) as DISPATCH_DELAY_SEC,
 cast(30 + (l_suppkey * 7919 + l_orderkey) % 3600 as bigint) as TRAVEL_TIME_SEC
 from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
 join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
 join part on l_partkey = p_partkey)
"""
LINE_COLUMNS = (
    "CAD_EVNT_ID, NYPD_PCT_CD, BORO_NM, RADIO_CODE, CIP_JOBS, ADD_TS, RESPONSE_TIME_SEC, "
    "DISPATCH_DELAY_SEC, TRAVEL_TIME_SEC"
).split(", ")

STAGES = {
    "raw": [EVENTS],
    "deduped": [EVENTS, DEDUPED],
    "typed": [EVENTS, DEDUPED, STAMPED],
    "cleaned": [EVENTS, DEDUPED, STAMPED, CODED, CLEANED],
    "scoped": [EVENTS, DEDUPED, STAMPED, CODED, CLEANED, SCOPED],
    "normalized": [EVENTS, DEDUPED, STAMPED, CODED, CLEANED, SCOPED, NORMALIZED],
    "lines": [LINES],
}


def on(stage: str, select: str, *more: str) -> str:
    """A select after the expressions up to ``stage`` and any further ones."""
    parts = [part.strip() for part in (*STAGES[stage], *more)]
    return "with " + ",\n".join(parts) + "\n" + select.strip()


# --- profiling ------------------------------------------------------------

TIME_TEXT = "'^([01]?[0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$'"


def violations(key: str, value: str, set_name: str, count_name: str, only: bool = True) -> str:
    having = f"having count(distinct {value}) > 1" if only else ""
    return on("raw", f"""
select {key}, coalesce(array_to_string(list_sort(list(distinct {value})
  filter (where {value} is not null)), ', '), '') as {set_name},
 count(distinct {value}) as {count_name} from raw group by {key} {having}""")


def pairs(key: str, value: str, count_name: str, only: bool = True) -> str:
    kept = f"n > 1 and r.{value} is not null" if only else f"(r.{value} is not null or n = 0)"
    return on("raw", f"""
select distinct r.{key}, r.{value}, n as {count_name} from raw r
 join (select {key}, count(distinct {value}) as n from raw group by {key}) k
 on r.{key} is not distinct from k.{key} where {kept}""")


def required(columns) -> str:
    return "select CAD_EVNT_ID, " + ", ".join(
        f"case when {ts(c) if c.endswith('_TS') else c} is null then 'missing' else 'ok' end "
        f"as {c}_status" for c in columns) + " from "


def status(c: str, readable: str) -> str:
    return (
        f"case when {c} is null then 'missing' when not coalesce({readable}, false) "
        f"then 'invalid' else 'ok' end as {c}_status"
    )


STAMP_NAMES = ("ADD_TS", "DISP_TS", "ARRIVD_TS", "CLOSNG_TS")
TIME_STATUS = ", ".join([
    status("INCIDENT_TIME", f"regexp_matches(trim(INCIDENT_TIME), {TIME_TEXT})"),
    *[status(c, f"{ts(c)} is not null") for c in STAMP_NAMES],
])
INCIDENT = "try_strptime(concat_ws(' ', INCIDENT_DATE, INCIDENT_TIME), '%m/%d/%Y %H:%M:%S')"


def overview() -> str:
    """Every scalar check as a row of its own."""
    late = gap(ts("ADD_TS"), INCIDENT)
    checks = {
        ("rows", "*"): "count(*)",
        ("max_length", "TYP_DESC"): "max(length(TYP_DESC))",
        ("late_by_60", "INCIDENT_TIME"): f"count(*) filter (where {late} > 60)",
        ("late_by_0", "INCIDENT_TIME"): f"count(*) filter (where {late} > 0)",
        ("invalid", "INCIDENT_TIME"):
            f"count(*) filter (where not regexp_matches(trim(INCIDENT_TIME), {TIME_TEXT}))",
        ("invalid_untrimmed", "INCIDENT_TIME"):
            f"count(*) filter (where not regexp_matches(INCIDENT_TIME, {TIME_TEXT}))",
        ("before_ADD_TS", "DISP_TS"): f"count(*) filter (where {ts('DISP_TS')} < {ts('ADD_TS')})",
        ("outside_domain", "BORO_NM"): "count(*) filter (where BORO_NM not in "
            "('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'))",
        ("before_CREATE_DATE", "INCIDENT_DATE"):
            f"count(*) filter (where {date('INCIDENT_DATE')} < {date('CREATE_DATE')})",
        ("after_CLOSNG_TS", "INCIDENT_DATE"):
            f"count(*) filter (where cast({date('INCIDENT_DATE')} as timestamp) > {ts('CLOSNG_TS')})",
    }
    for c in RAW_LIST:
        checks["null", c] = f"count(*) filter (where {c} is null)"
        checks["null_or_blank", c] = f"count(*) filter (where {c} is null or trim({c}) = '')"
    for c in ("CREATE_DATE", "INCIDENT_DATE"):
        checks["earliest", c], checks["latest", c] = f"min({date(c)})", f"max({date(c)})"
    for c in STAMP_NAMES:
        checks["invalid", c] = f"count(*) filter (where {c} is not null and {ts(c)} is null)"
    for c in ("CAD_EVNT_ID", "ARRIVD_TS", "CLOSNG_TS", "RADIO_CODE", "TYP_DESC"):
        checks["missing", c] = f"count(*) filter (where {ts(c) if c.endswith('_TS') else c} is null)"
    return " union all ".join(
        f"select '{check}' as check_name, '{c}' as column_name, cast({value} as varchar) as value from raw"
        for (check, c), value in checks.items())


def profiling() -> dict[str, str]:
    counts = " union all ".join(
        f"select '{c}' as column_name, count(*) as num_distinct "
        f"from (select distinct {c} from raw)" for c in RAW_LIST
    )
    invalid = " union all ".join(
        f"select '{c}_status' as column_name, count(*) filter (where {c}_status = 'invalid') "
        f"as num_invalid from st" for c in ("INCIDENT_TIME", *STAMP_NAMES)
    )
    late = f"""late as (select *, {INCIDENT} as INCIDENT_TS_FORMATTED,
      {ts('ADD_TS')} as ADD_TS_FORMATTED from raw)"""
    late_gap = gap("ADD_TS_FORMATTED", "INCIDENT_TS_FORMATTED")
    return {
        "raw_row_count": on("raw", "select count(*) as num_rows, "
                            "cast(sum(1) as bigint) as num_rows_summed from raw"),
        "raw_distinct_values_borough": on("raw", "select distinct BORO_NM from raw"),
        "raw_distinct_counts": on("raw", counts),
        "raw_overview": on("raw", overview()),
        "raw_distinct_sketches": on("raw", f"""
select *, true as sketch_is_near from ({counts} union all select 'RADIO_CODE, TYP_DESC', count(*)
 from (select distinct RADIO_CODE, TYP_DESC from raw))"""),
        "raw_desc_severity_cells": on("raw", """
select TYP_DESC, cast(0 as bigint) as chunk, coalesce(array_to_string(list_sort(list(distinct CIP_JOBS)
  filter (where CIP_JOBS is not null)), ', '), '') as CIP_JOBS_set,
 count(distinct CIP_JOBS) as num_CIP_JOBS from raw group by TYP_DESC"""),
        "raw_pair_count": on("raw", "select count(*) as num_pairs from "
                             "(select distinct RADIO_CODE, TYP_DESC from raw)"),
        "raw_desc_to_codes": violations("TYP_DESC", "RADIO_CODE", "RADIO_CODES", "num_codes"),
        "raw_code_to_descs": violations("RADIO_CODE", "TYP_DESC", "TYP_DESCS", "num_descs"),
        "raw_desc_to_severity": violations("TYP_DESC", "CIP_JOBS", "CIP_JOBS_set", "num_CIP_JOBS"),
        "raw_desc_to_codes_pairs": pairs("TYP_DESC", "RADIO_CODE", "num_codes"),
        "raw_code_to_descs_pairs": pairs("RADIO_CODE", "TYP_DESC", "num_descs"),
        "raw_desc_to_severity_pairs": pairs("TYP_DESC", "CIP_JOBS", "num_CIP_JOBS"),
        "raw_desc_severity_map_pairs": pairs("TYP_DESC", "CIP_JOBS", "num_CIP_JOBS", only=False),
        "raw_desc_violation_counts": on("raw", """
select TYP_DESC, count(distinct RADIO_CODE) as num_codes from raw group by TYP_DESC
 having count(distinct RADIO_CODE) > 1"""),
        "raw_desc_severity_map": violations(
            "TYP_DESC", "CIP_JOBS", "CIP_JOBS_set", "num_CIP_JOBS", only=False),
        "raw_missing_desc": on("raw", "select distinct RADIO_CODE, TYP_DESC from raw "
                               "where TYP_DESC is null or trim(TYP_DESC) = ''"),
        "raw_duplicate_keys": on("raw", "select CAD_EVNT_ID, count(*) as num_rows from raw "
                                 "group by CAD_EVNT_ID having count(*) > 1"),
        "raw_max_length": on("raw", "select cast(max(length(TYP_DESC)) as integer) "
                             "as max_TYP_DESC_len from raw"),
        "raw_date_range": on("raw", "select " + ", ".join(
            f"{b}({date(c)}) as {b}_{c}" for c in ("CREATE_DATE", "INCIDENT_DATE")
            for b in ("min", "max")) + " from raw"),
        "raw_late_incidents": on("raw", f"select * from late where {late_gap} > 60", late),
        "raw_late_incidents_count": on(
            "raw", "select count(*) as num_rows, cast(coalesce(sum(1), 0) as bigint) "
            f"as num_rows_summed from late where {late_gap} > 60", late),
        "raw_late_incidents_first": on(
            "raw", f"select * from late where {late_gap} > 60 order by "
            + ", ".join(f"{c} asc nulls last" for c in RAW_LIST) + " limit 10", late),
        "raw_late_incidents_strict": on(
            "raw", "select count(*) as num_rows, cast(coalesce(sum(1), 0) as bigint) "
            "as num_rows_summed from late where INCIDENT_TS_FORMATTED > ADD_TS_FORMATTED", late),
        "raw_time_status": on("raw", f"select CAD_EVNT_ID, {TIME_STATUS} from raw"),
        "raw_status_counts": on("raw", invalid, f"st as (select {TIME_STATUS} from raw)"),
        "raw_dispatch_before_add": on(
            "raw", f"select count(*) as num_violations from raw "
            f"where {ts('DISP_TS')} < {ts('ADD_TS')}"),
        "raw_required_status": on("raw", required(
            ("CAD_EVNT_ID", "ARRIVD_TS", "CLOSNG_TS", "RADIO_CODE", "TYP_DESC")) + "raw"),
        "raw_required_status_patrol": on("raw", required((
            "CAD_EVNT_ID", "ARRIVD_TS", "CLOSNG_TS", "PATRL_BORO_NM", "RADIO_CODE", "TYP_DESC",
        )) + "patrol", """patrol as (select *, case when try_cast(CAD_EVNT_ID as bigint) % 53 = 0
            then null else 'PATROL ' || BORO_NM end as PATRL_BORO_NM from raw)"""),
        "raw_domain_status": on("raw", """
select CAD_EVNT_ID, BORO_NM, case when BORO_NM not in
 ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST') then 'invalid' else 'ok' end
 as BORO_NM_status from raw"""),
        "raw_date_order_status": on("raw", f"""
select CAD_EVNT_ID, case when {date('INCIDENT_DATE')} < {date('CREATE_DATE')}
  then 'before_CREATE_DATE' else 'ok' end as INCIDENT_DATE_check1,
 case when cast({date('INCIDENT_DATE')} as timestamp) > {ts('CLOSNG_TS')}
  then 'after_CLOSNG_TS' else 'ok' end as INCIDENT_DATE_check2 from raw"""),
        "raw_order_status": on("raw", f"""
select CAD_EVNT_ID, case when not regexp_matches(INCIDENT_TIME, {TIME_TEXT}) then 'invalid'
  else 'ok' end as INCIDENT_TIME_status,
 case when {ts('DISP_TS')} < {ts('ADD_TS')} then 'DISP_before_ADD' else 'ok' end
  as DISP_ADD_check from raw"""),
        "cleaned_borough_domain": on("cleaned", """
select BORO_NM, (select count(*) from (select distinct BORO_NM from cleaned)) as num_distinct
 from (select distinct BORO_NM from cleaned)"""),
    }


# --- cleaning -------------------------------------------------------------

def cleaning() -> dict[str, str]:
    return {
        "etl_dedup": on("deduped", "select * from deduped"),
        "etl_typed_durations": on("typed", "select * exclude (INCIDENT_TS) from typed"),
        "etl_category_index": on(
            "deduped", "select CAD_EVNT_ID, TYP_DESC, coalesce(code, -1) as TYP_DESC_ENUM "
            "from deduped left join codes on TYP_DESC = v",
            "codes as (select v, cast(row_number() over (order by v) - 1 as bigint) as code from "
            "(select distinct TYP_DESC as v from deduped where TYP_DESC is not null))"),
        "etl_category_dense_rank": on(
            "deduped", "select CAD_EVNT_ID, TYP_DESC, cast(dense_rank() over "
            "(order by TYP_DESC nulls first) as bigint) as TYP_DESC_ENUM from deduped"),
        "etl_valid_borough": on(
            "typed", f"select CAD_EVNT_ID, BORO_NM from typed where {GOOD_BOROUGH}"),
        "etl_dispatch_order": on(
            "typed", f"select CAD_EVNT_ID, ADD_TS, DISP_TS from typed where {GOOD_DISPATCH}"),
        "etl_incident_tolerance": on(
            "typed", f"select CAD_EVNT_ID, INCIDENT_TS, ADD_TS from typed where {GOOD_INCIDENT}"),
        "etl_clean": on("cleaned", "select * from cleaned"),
        "etl_scope": on("scoped", "select * from scoped"),
        "etl_normalize": on("normalized", "select * from normalized"),
        "etl_normalize_from_text": on("normalized", "select * from normalized"),
        "etl_reject_ledger": on("cleaned", " union all ".join(
            f"select '{stage}' as stage, {i} as step, '{rule}' as rule, count(*) as num_rows "
            f"from {table} where {condition}" for stage, i, rule, table, condition in (
                ("clean", 0, "rows_in", "typed", "true"),
                ("clean", 1, "valid_borough", "typed", f"not coalesce({GOOD_BOROUGH}, false)"),
                ("clean", 2, "dispatched_in_order", "typed", f"{GOOD_BOROUGH} and not {GOOD_DISPATCH}"),
                ("clean", 3, "incident_within", "typed",
                 f"{GOOD_BOROUGH} and {GOOD_DISPATCH} and not {GOOD_INCIDENT}"),
                ("clean", 4, "rows_out", "cleaned", "true"),
                ("scope", 0, "rows_in", "cleaned", "true"),
                ("scope", 1, "severity_in_scope", "cleaned", f"not {IN_SCOPE}"),
                ("scope", 2, "responded_after", "cleaned",
                 f"{IN_SCOPE} and not coalesce(RESPONSE_TIME_SEC > 90, false)"),
                ("scope", 3, "rows_out", "cleaned", f"{IN_SCOPE} and RESPONSE_TIME_SEC > 90"),
            ))),
        "etl_hms_wrap24": on("typed", "select CAD_EVNT_ID, " + ", ".join(
            f"{hms_wrapped(n + '_SEC')} as {n}" for n in DURATIONS) + " from typed"),
    }


# --- statistics -----------------------------------------------------------

def stat(kind: str, column: str) -> str:
    return {
        "avg": f"avg({column})",
        "median": f"cast(quantile_disc({column}, 0.5) as bigint)",
        "stddev": f"round(stddev_samp({column}), 6)",
        "min": f"min({column})",
        "max": f"max({column})",
    }[kind]


METRICS = {
    "response": "RESPONSE_TIME_SEC",
    "dispatch": "DISPATCH_DELAY_SEC",
    "travel": "TRAVEL_TIME_SEC",
}


def statistics() -> dict[str, str]:
    def columns(kind, suffix):
        return ", ".join(f"{stat(kind, n + '_SEC')} as {n}_{suffix}_sec" for n in DURATIONS)

    modes = " union all ".join(f"""(select '{c}' as column_name, cast({c} as varchar) as mode,
     count(*) as num_records from normalized group by {c}
     order by count(*) desc, {c} asc nulls last limit 1)"""
                               for c in ("BORO_NM", "RADIO_CODE", "TYP_DESC_ENUM", "CIP_JOBS"))
    return {
        "stats_means": on("normalized", f"select {columns('avg', 'mean')} from normalized"),
        "stats_medians": on("normalized", f"select {columns('median', 'median')} from normalized"),
        "stats_stddevs": on("normalized", f"select {columns('stddev', 'stddev')} from normalized"),
        "stats_modes": on("normalized", modes),
    }


# --- grouped profiles -----------------------------------------------------

BASIC = ("avg", "median", "stddev")


def grouped(
    table: str, keys: str, metrics: dict, stats=BASIC, where: str = "RESPONSE_TIME_SEC > 0",
    count: str = "num_records", key_expr: str | None = None, upper: bool = False,
) -> str:
    """A grouped profile in seconds as a select."""
    def name(kind, metric):
        text = f"{kind}_{metric}_sec"
        return text.upper() if upper else text

    columns = ", ".join(
        f"{stat(kind, column)} as {name(kind, metric)}"
        for metric, column in metrics.items() for kind in stats
    )
    return (
        f"select {key_expr or keys}, {columns}, count(*) as {count} from {table} "
        f"where {where} group by all"
    )


def texts(stats, metrics, upper: bool = False) -> str:
    """The text columns beside seconds columns; stddev text needs unrounded seconds."""
    def one(kind, metric):
        seconds, text = f"{kind}_{metric}_sec", f"{kind}_{metric}_time"
        if upper:
            seconds, text = seconds.upper(), text.upper()
        return f"{hms(seconds)} as {text}"

    return ", ".join(one(kind, metric) for metric in metrics for kind in stats)


RESPONSE = {"response": "RESPONSE_TIME_SEC"}
HOURLY = {
    "response": "RESPONSE_TIME_SEC",
    "dispatch_delay": "DISPATCH_DELAY_SEC",
    "travel": "TRAVEL_TIME_SEC",
}
HOUR = "cast(hour(ADD_TS) as integer) as hour_of_day"
PARTS = {
    "hour_of_day": HOUR,
    "month": "cast(month(ADD_TS) as integer) as month",
    "day_of_week": "strftime(ADD_TS, '%a') as day_of_week",
}
TYPES = """case left(RADIO_CODE, 2) when '10' then 'INVESTIGATE/POSSIBLE CRIME'
 when '13' then 'ASSIST POLICE OFFICER' when '30' then 'ROBBERY (IN PROGRESS)'
 when '31' then 'BURGLARY (IN PROGRESS)' when '32' then 'LARCENY (IN PROGRESS)'
 when '34' then 'ASSAULT (IN PROGRESS)' when '39' then 'OTHER CRIMES (IN PROGRESS)'
 when '51' then 'ROVING BAND' when '66' then 'UNUSUAL INCIDENT' else 'UNKNOWN' end"""
DETAIL_STATS = ("avg", "median", "min", "max")


def area(table: str, keys: str) -> str:
    return "area as (" + grouped(
        table, keys, RESPONSE, count="NUM_RECORDS", upper=True) + ")"


AREA_OUT = f"select *, {texts(BASIC, RESPONSE, upper=True)} from area"


def detail(table: str, keys: str) -> str:
    return "detail as (" + grouped(
        table, keys, RESPONSE, DETAIL_STATS, count="INCIDENT_COUNT", upper=True,
        key_expr=f"{keys}, left(RADIO_CODE, 2) as RADIO_CODE_PREFIX, {TYPES} as TYP_DESC, CIP_JOBS",
    ) + ")"


DETAIL_OUT = f"select *, {texts(DETAIL_STATS, RESPONSE, upper=True)} from detail"
PCT = "BORO_NM, NYPD_PCT_CD"


def severity(table: str) -> str:
    return "severity as (" + grouped(
        table, "CIP_JOBS", METRICS, ("avg", "median"),
        where="CIP_JOBS is not null and RESPONSE_TIME_SEC > 0") + ")"


SEVERITY_OUT = f"select *, {texts(('avg', 'median'), METRICS)} from severity"


def hourly(side: str, metrics: dict) -> str:
    return "hourly as (" + grouped(
        "normalized", "", metrics, ("avg",), key_expr=HOUR,
        where=f"RESPONSE_TIME_SEC > 0 and CIP_JOBS {side} 'NON CRITICAL'") + ")"


def hourly_out(metrics: dict) -> str:
    return f"select *, {texts(('avg',), metrics)} from hourly"


def metric(keys: str, name: str) -> str:
    column = METRICS[name]
    return grouped("normalized", keys, {name: column}, where=f"{column} > 0")


def by_part(part: str, table: str = "normalized") -> str:
    return grouped(table, "", RESPONSE, key_expr=PARTS[part])


def grouped_queries() -> dict[str, str]:
    n = "normalized"
    return {
        "borough_profile": on(n, AREA_OUT, area(n, "BORO_NM")),
        "borough_profile_seconds": on(n, metric("BORO_NM", "response")),
        "borough_detail": on(n, DETAIL_OUT, detail(n, "BORO_NM")),
        "borough_detail_by_borough": on(n, DETAIL_OUT + " order by BORO_NM nulls last, "
            "AVG_RESPONSE_SEC desc, RADIO_CODE_PREFIX nulls last, CIP_JOBS nulls last",
            detail(n, "BORO_NM")),
        "borough_detail_by_type": on(n, DETAIL_OUT + " order by TYP_DESC nulls last, "
            "CIP_JOBS nulls last, AVG_RESPONSE_SEC desc, BORO_NM nulls last, "
            "RADIO_CODE_PREFIX nulls last", detail(n, "BORO_NM")),
        "precinct_profile": on(n, AREA_OUT, area(n, PCT)),
        "precinct_profile_seconds": on(n, metric(PCT, "response")),
        "precinct_detail": on(n, DETAIL_OUT, detail(n, PCT)),
        "severity_profile": on(n, SEVERITY_OUT, severity(n)),
        "severity_profile_seconds": on(n, "select * from severity", severity(n)),
        "dispatch_by_borough": on(n, metric("BORO_NM", "dispatch")),
        "dispatch_by_precinct": on(n, metric(PCT, "dispatch")),
        "travel_by_borough": on(n, metric("BORO_NM", "travel")),
        "travel_by_precinct": on(n, metric(PCT, "travel")),
        "borough_by_type": on(n, grouped(
            n, "BORO_NM, TYP_DESC_ENUM", RESPONSE, ("avg", "median"),
            where="TYP_DESC_ENUM is not null and RESPONSE_TIME_SEC > 0")),
        "hourly_noncritical": on(n, hourly_out(HOURLY), hourly("=", HOURLY)),
        "hourly_high_severity": on(n, hourly_out(HOURLY), hourly("<>", HOURLY)),
        "hourly_noncritical_short": on(n, hourly_out(RESPONSE), hourly("=", RESPONSE)),
        "hourly_high_severity_short": on(n, hourly_out(RESPONSE), hourly("<>", RESPONSE)),
        "profile_by_hour": on(n, by_part("hour_of_day")),
        "profile_by_month": on(n, by_part("month")),
        "profile_by_weekday": on(n, by_part("day_of_week")),
        "hour_by_borough": on(n, grouped(
            n, "", RESPONSE, ("avg",), key_expr=f"{HOUR}, BORO_NM")),
        "hour_by_severity": on(n, grouped(
            n, "", RESPONSE, ("avg",), key_expr=f"{HOUR}, CIP_JOBS",
            where="CIP_JOBS is not null and RESPONSE_TIME_SEC > 0")),
    }


# --- ranking --------------------------------------------------------------

TIES = "BORO_NM asc nulls last, NYPD_PCT_CD asc nulls last, RADIO_CODE_PREFIX asc nulls last"


def rank(direction: str) -> str:
    return (
        "cast(row_number() over (partition by TYP_DESC, CIP_JOBS "
        f"order by AVG_RESPONSE_SEC {direction}, {TIES}) as integer)"
    )


RANKED = (
    f"ranked as (select *, {rank('asc')} as RANK_FAST, {rank('desc')} as RANK_SLOW from detail)"
)
def picked(k: int) -> str:
    return f"""picked as (
 select *, 'TOP_{k}_FASTEST' as GROUP_TYPE from ranked where RANK_FAST <= {k}
 union all select *, 'BOTTOM_{k}_SLOWEST' as GROUP_TYPE from ranked where RANK_SLOW <= {k})"""


PICKED = picked(5)
PICKED_OUT = (
    "select * exclude (RANK_FAST, RANK_SLOW), "
    f"{texts(DETAIL_STATS, RESPONSE, upper=True)} from picked"
)


def ranking() -> dict[str, str]:
    n = "normalized"

    def precincts(name, direction):
        return on(n, f"select * from ({metric(PCT, name)}) order by avg_{name}_sec {direction}, "
                  "BORO_NM, NYPD_PCT_CD limit 10")

    def slowest(part):
        return on(n, f"select * from ({by_part(part)}) "
                  f"order by avg_response_sec desc, {part} limit 5")

    def slowest_of_split(side):
        return on(n, f"{hourly_out(RESPONSE)} order by avg_response_sec desc, hour_of_day limit 5",
                  hourly(side, RESPONSE))

    return {
        "precinct_ranks": on(n, "select * from ranked", detail(n, PCT), RANKED),
        "precinct_ranks_in_slices": on(
            n, "select * replace (cast(RANK_FAST as bigint) as RANK_FAST, "
            "cast(RANK_SLOW as bigint) as RANK_SLOW) from ranked", detail(n, PCT), RANKED),
        "precinct_top_bottom": on(n, PICKED_OUT, detail(n, PCT), RANKED, PICKED),
        "precinct_top_bottom_3": on(n, PICKED_OUT, detail(n, PCT), RANKED, picked(3)),
        "slowest_precincts": precincts("response", "desc"),
        "fastest_precincts": precincts("response", "asc"),
        "slowest_dispatch": precincts("dispatch", "desc"),
        "fastest_dispatch": precincts("dispatch", "asc"),
        "slowest_travel": precincts("travel", "desc"),
        "fastest_travel": precincts("travel", "asc"),
        "slowest_hours": slowest("hour_of_day"),
        "slowest_hours_noncritical": slowest_of_split("="),
        "slowest_hours_high_severity": slowest_of_split("<>"),
        "slowest_months": slowest("month"),
        "mart_preview": on(n, f"{AREA_OUT} order by AVG_RESPONSE_SEC desc, BORO_NM, NYPD_PCT_CD "
                           "limit 5", area(n, PCT)),
    }


# --- charts ---------------------------------------------------------------

def minutes(seconds: str) -> str:
    """Minutes of the text of a duration: whole seconds over sixty."""
    return f"cast(trunc({seconds}) as bigint) / 60.0::double"


def charts() -> dict[str, str]:
    n = "normalized"
    regions = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
    def cell(condition, name):
        return f'round(avg(case when {condition} then {minutes("AVG_RESPONSE_SEC")} end), 6) as "{name}"'

    def cells(listed):
        names = ", ".join(f"'{r}'" for r in listed)
        return ", ".join([cell(f"BORO_NM = '{r}'", r) for r in listed] + [
            cell(f"coalesce(BORO_NM not in ({names}), true)", "OTHER_BOROUGHS")])

    order = ("case CIP_JOBS when 'CRITICAL' then 0 when 'SERIOUS' then 1 "
             "when 'NON CRITICAL' then 2 else 3 end")
    title = "TYP_DESC || ' (' || CIP_JOBS || ')' as TITLE"
    known = "TYP_DESC is not null and CIP_JOBS is not null"
    stack = (
        f"{minutes('avg_{0}_sec')} as DISPATCH_MIN, {minutes('avg_travel_sec')} as TRAVEL_MIN, "
        f"{minutes('avg_{0}_sec')} as TRAVEL_BASE_MIN"
    )
    hourly_select = f"select hour_of_day, {stack.format('dispatch_delay')}, num_records from hourly"
    return {
        "chart_borough": on(n, f"select BORO_NM, {minutes('AVG_RESPONSE_SEC')} as AVG_MIN, "
                            "NUM_RECORDS from area", area(n, "BORO_NM")),
        **{name: on(n, f"""
select TYP_DESC || ' | ' || CIP_JOBS as INCIDENT_PAIR, cast({order} as integer) as SEVERITY_ORDER,
 {cells(listed)} from detail where {known} group by TYP_DESC, CIP_JOBS""", detail(n, "BORO_NM"))
           for name, listed in (("chart_pair_matrix", regions), ("chart_pair_matrix_other", regions[:3]))},
        "chart_pair_cells": on(n, f"""
select TYP_DESC || ' | ' || CIP_JOBS as INCIDENT_PAIR, cast({order} as integer) as SEVERITY_ORDER,
 BORO_NM, round(avg({minutes('AVG_RESPONSE_SEC')}), 6) as AVG_MIN
 from detail where {known} group by TYP_DESC, CIP_JOBS, BORO_NM""", detail(n, "BORO_NM")),
        "chart_precinct_points": on(
            n, "select BORO_NM, NYPD_PCT_CD, NUM_RECORDS, "
            f"{minutes('AVG_RESPONSE_SEC')} as AVG_MIN from area", area(n, PCT)),
        "chart_facets": on(n, f"select distinct TYP_DESC, CIP_JOBS, {title} from picked "
                           f"where {known}", detail(n, PCT), RANKED, PICKED),
        **{name: on(n, f"""
select {title}, cast(NYPD_PCT_CD as varchar) as PRECINCT,
 {minutes('AVG_RESPONSE_SEC')} as AVG_MIN,
 case GROUP_TYPE when 'TOP_{k}_FASTEST' then 'green' else 'red' end as COLOUR
 from picked where {known}""", detail(n, PCT), RANKED, picked(k))
           for name, k in (("chart_ranked_facets", 5), ("chart_ranked_facets_3", 3))},
        "chart_severity": on(n, f"select CIP_JOBS, {minutes('avg_response_sec')} as AVG_MIN, "
                             "num_records from severity", severity(n)),
        "chart_severity_stack": on(
            n, f"select CIP_JOBS, {stack.format('dispatch')} from severity", severity(n)),
        "chart_hourly": on(n, hourly_select, hourly("=", HOURLY)),
        "chart_hourly_high_severity": on(n, hourly_select, hourly("<>", HOURLY)),
    }


# --- order lines ----------------------------------------------------------

def order_lines() -> dict[str, str]:
    t = "lines"
    return {
        "lineitem_group_profile": on(t, grouped(t, "BORO_NM", RESPONSE)),
        "lineitem_precinct_detail": on(t, DETAIL_OUT, detail(t, PCT)),
        "lineitem_top_bottom": on(t, PICKED_OUT, detail(t, PCT), RANKED, PICKED),
        "lineitem_severity_profile": on(t, SEVERITY_OUT, severity(t)),
        "lineitem_profile_by_hour": on(t, by_part("hour_of_day", t)),
        "lineitem_ranks_in_slices": on(t, """
select CAD_EVNT_ID, BORO_NM, RESPONSE_TIME_SEC,
 row_number() over (partition by BORO_NM order by RESPONSE_TIME_SEC, CAD_EVNT_ID) as RANK_FAST,
 row_number() over (partition by BORO_NM order by RESPONSE_TIME_SEC desc, CAD_EVNT_ID) as RANK_SLOW
 from (select distinct CAD_EVNT_ID, BORO_NM, RESPONSE_TIME_SEC from lines)"""),
        "lineitem_dedup": on(t, dedup("lines", LINE_COLUMNS)),
    }


def statements() -> dict[str, str]:
    return {
        **profiling(), **cleaning(), **statistics(), **grouped_queries(), **ranking(), **charts(),
        **order_lines(),
    }
