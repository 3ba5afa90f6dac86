"""Descriptive statistics and grouped response-time profiles.

Means, extremes and counts are plain hash aggregation: partial results are
merged before the shuffle, so group sizes do not matter.

Medians are exact by default, in two passes over the rows.  The first keeps a quantile sketch of
each group, merged before and after the shuffle like a sum, which only bounds the middle; the second
counts each value between the bounds, everything below as the lower bound and everything above as the
upper one, so that what a group sends is small however many values it has.  Groups are the only
thing either pass shuffles by.  From a stored table of counted seconds medians follow without a second
pass over the rows.  With ``accuracy`` given, they come from ``percentile_approx`` instead.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from turnout.functions import calendar_parts, code_prefix, format_hms, map_code
from turnout.operators.cleaning import high_severity, non_critical, positive
from turnout.schema import CATEGORY_COLUMNS, SECONDS_COLUMNS

RESPONSE = "RESPONSE_TIME_SEC"
DISPATCH = "DISPATCH_DELAY_SEC"
TRAVEL = "TRAVEL_TIME_SEC"


# --- statistics of rows ----------------------------------------------------

#: The sketch errs by one rank in SKETCH at most; the bounds lie MARGIN of the ranks from the middle.
SKETCH, MARGIN = 200, 0.05


def _of(name: str, stat: str) -> str:
    return f"_{stat}_of_{name}"


def summarize_rows(df: DataFrame, keys, metrics: dict[str, str], stats) -> DataFrame:
    """A row per group with ``stats`` of each metric, as ``_of`` names them, and ``_count``.

    ``stats`` holds any of avg, median, stddev, min and max.  Bounds are joined to the rows by one struct, in
    which nulls are equal; the second pass groups by the keys themselves, so the rows of a frequent key are
    reduced where they are and may be split in the join.
    """
    rows = df.select(
        *keys, *[F.col(column).alias(f"_{name}") for name, column in metrics.items()],
        F.struct(*keys).alias("_group"))
    simple = {"avg": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    around = F.array(F.lit(0.5 - MARGIN), F.lit(0.5 + MARGIN))
    first = rows.groupBy(*keys).agg(
        F.count("*").alias("_count"),
        *[simple[stat](f"_{name}").alias(_of(name, stat)) for name in metrics for stat in stats if stat != "median"],
        *[f(f"_{name}").alias(_of(name, stat)) for name in metrics for stat, f in (
            ("known", F.count), ("bounds", lambda c: F.percentile_approx(c, around, SKETCH)))],
    )
    # What the first pass found comes along with the bounds: one value a group.
    found = [c for c in first.columns if c not in keys]
    first = first.select(F.struct(*keys).alias("_of_group"), *found)
    kinds = dict(rows.dtypes)
    return rows.join(first, F.col("_group") == F.col("_of_group")).groupBy(*keys).agg(
        *[F.any_value(c).alias(c) for c in found],
        *[_middle(name, kinds[f"_{name}"]).alias(_of(name, "median")) for name in metrics],
    )


def _middle(name: str, kind: str) -> Column:
    """The first value that at least half of the known ones do not exceed, by bounds around it."""
    value, bounds, known = f"_{name}", _of(name, "bounds"), f"max({_of(name, 'known')})"
    cut = f"if({value} is null, null, greatest({bounds}[0], least({bounds}[1], {value})))"
    middle = f"cast(percentile_disc(0.5) within group (order by {cut}) as {kind})"
    below, above = f"count_if({value} < {bounds}[0])", f"count_if({value} > {bounds}[1])"
    return F.expr(f"""
        if({known} = 0 or ({below} * 2 < {known} and {above} * 2 <= {known}), {middle},
           raise_error('the middle of {name} lies outside the bounds of its sketch'))
    """)


# --- statistics from counted seconds --------------------------------------

def count_seconds(df: DataFrame, keys, metrics: dict[str, str]) -> DataFrame:
    """Number of rows per group, metric and second: ``keys``, _metric, _seconds, _rows.

    ``metrics`` maps a short name to a column.  Null durations are counted in a
    row of their own.
    """
    cells = df.select(*keys, *[F.col(column).alias(name) for name, column in metrics.items()])
    if len(metrics) == 1:
        (name,) = metrics
        cells = cells.select(*keys, F.lit(name).alias("_metric"), F.col(name).alias("_seconds"))
    else:
        cells = cells.unpivot(list(keys), list(metrics), "_metric", "_seconds")
    return cells.groupBy(*keys, "_metric", "_seconds").agg(F.count("*").alias("_rows"))


FINE = 64  # values below it are buckets of their own; above it, buckets double in width with each power of two


def _bucket(value: str) -> str:
    """SQL for the bucket of a number, ascending with it: 64 for each power of two on either side."""
    size = f"abs({value})"
    power = f"pow(2D, floor(log2({size})) - 6)"
    wide = f"(floor(log2({size})) - 6) * {FINE} + floor({size} / {power})"
    return f"bigint(sign({value}) * if({size} < {FINE}, floor({size}), {wide}))"


def _base(bucket: str) -> str:
    """SQL for a number in or next to a bucket, from which its values differ little."""
    size = f"abs({bucket})"
    wide = f"({FINE} + ({size} - {FINE}) % {FINE}) * pow(2D, ({size} - {FINE}) div {FINE})"
    return f"(sign({bucket}) * if({size} < {FINE}, double({size}), {wide}))"


def summarize_counts(counts: DataFrame, keys) -> DataFrame:
    """Count, average, median, deviation and extremes per group and metric.

    All but the median follow from sums by bucket.
    """
    group = [*keys, "_metric"]
    rows = counts.withColumn("_bucket", F.expr(_bucket("_seconds")))
    off = f"(_seconds - {_base('_bucket')})"
    buckets = rows.groupBy(*group, "_bucket").agg(
        F.sum("_rows").alias("_all"),
        F.sum(F.expr("_seconds * _rows")).alias("_sum"),
        F.sum(F.expr(f"{off} * _rows")).alias("_off"),
        F.sum(F.expr(f"{off} * {off} * _rows")).alias("_off2"),
        F.min("_seconds").alias("_low"), F.max("_seconds").alias("_high"),
    )
    ordered = Window.partitionBy(*group).orderBy(F.asc_nulls_last("_bucket"))
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = F.expr("if(_bucket is not null, _all, 0)")
    placed = buckets.withColumns({
        "_upto": F.sum(known).over(upto),
        "_known": F.sum(known).over(whole),
        "_total": F.sum("_sum").over(whole),
    }).withColumn("_mean", F.expr("try_divide(_total, _known)"))
    # The middle bucket is the first whose rows and those before are at least half.
    middle = F.expr("_bucket is not null and _upto * 2 >= _known and (_upto - _all) * 2 < _known")
    base = _base("_bucket")
    spread = f"(_off2 + 2 * ({base} - _mean) * _off + _all * ({base} - _mean) * ({base} - _mean))"
    summary = placed.groupBy(*group).agg(
        F.sum("_all").alias("_count"),
        F.max("_mean").alias("_avg"),
        F.expr(f"if(max(_known) > 1, sqrt(greatest(sum({spread}), 0D) / (max(_known) - 1)), null)").alias("_stddev"),
        F.min("_low").alias("_min"),
        F.max("_high").alias("_max"),
        F.max(F.when(middle, F.col("_bucket"))).alias("_middle"),
        F.max(F.when(middle, F.expr("_upto - _all"))).alias("_before"),
        F.max("_known").alias("_n"),
    )
    # Values of the middle buckets only, each group's in order.  No part of the join rejects nulls,
    # so that no filter on this side keeps the counts from being shuffled once for both readers.
    own = summary.select(*[F.col(k).alias(f"_of_{k}") for k in group], "_middle", "_before", "_n")
    same = F.col("_bucket").eqNullSafe(F.col("_middle"))
    for k in group:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    inside = Window.partitionBy(*group).orderBy("_seconds").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    medians = (
        rows.join(own, same)
        .withColumn("_upto", F.sum("_rows").over(inside) + F.col("_before"))
        # The first value that at least half of the rows do not exceed.
        .where("_upto * 2 >= _n")
        .groupBy(*[F.col(k).alias(f"_of_{k}") for k in group]).agg(F.min("_seconds").alias("_median"))
    )
    for k in group:
        condition = F.col(k).eqNullSafe(F.col(f"_of_{k}"))
        same = condition if k == group[0] else same & condition
    return summary.join(medians, same, "left").select(
        *group, "_count", "_avg", "_median", "_stddev", "_min", "_max"
    )


APPROXIMATE = {
    "avg": lambda column, accuracy: F.avg(column),
    "median": lambda column, accuracy: F.percentile_approx(column, 0.5, accuracy),
    "stddev": lambda column, accuracy: F.stddev_samp(column),
    "min": lambda column, accuracy: F.min(column),
    "max": lambda column, accuracy: F.max(column),
}


def group_profile(
    df: DataFrame,
    keys,
    metrics: dict[str, str] | None = None,
    stats=("avg", "median", "stddev"),
    count_name: str = "num_records",
    accuracy: int | None = None,
) -> DataFrame:
    """Statistics of one or more second columns by ``keys``, plus the row count.

    ``metrics`` maps a short name to a column; results are named
    ``<stat>_<name>_sec``.  A median is an element, never interpolated.
    """
    metrics = {"response": RESPONSE} if metrics is None else metrics
    names = [(name, stat, f"{stat}_{name}_sec") for name in metrics for stat in stats]
    if accuracy is not None or "median" not in stats:
        return df.groupBy(*keys).agg(
            *[APPROXIMATE[stat](metrics[name], accuracy).alias(out) for name, stat, out in names],
            F.count("*").alias(count_name),
        )
    return summarize_rows(df, keys, metrics, stats).select(
        *keys, *[F.col(_of(name, stat)).alias(out) for name, stat, out in names],
        F.col("_count").alias(count_name),
    )


def profile_of_counts(
    counts: DataFrame, keys, name: str = "response", stats=("avg", "median", "stddev"),
    count_name: str = "num_records",
) -> DataFrame:
    """``group_profile`` of one metric from counts by ``keys`` and perhaps more columns."""
    extra = set(counts.columns) - {*keys, "_metric", "_seconds", "_rows"}
    if extra:
        counts = counts.groupBy(*keys, "_metric", "_seconds").agg(F.sum("_rows").alias("_rows"))
    return summarize_counts(counts, keys).select(
        *keys, *[F.col(f"_{stat}").alias(f"{stat}_{name}_sec") for stat in stats],
        F.col("_count").alias(count_name),
    )


# --- whole columns --------------------------------------------------------

def _names(columns, stat):
    return {c: f"{c.removesuffix('_SEC')}_{stat}_sec" for c in columns}


def means(df: DataFrame, columns=SECONDS_COLUMNS) -> DataFrame:
    return df.agg(*[F.avg(c).alias(name) for c, name in _names(columns, "mean").items()])


def medians(df: DataFrame, columns=SECONDS_COLUMNS, accuracy: int | None = None) -> DataFrame:
    names = _names(columns, "median")
    if accuracy is not None:
        return df.agg(*[
            F.percentile_approx(c, 0.5, accuracy).alias(name) for c, name in names.items()
        ])
    cells = df.select(*columns).unpivot([], list(columns), "_metric", "_seconds")
    summary = summarize_rows(cells, ["_metric"], {"all": "_seconds"}, ("median",))
    return summary.agg(*[
        F.max(F.when(F.col("_metric") == c, F.col(_of("all", "median")))).alias(name)
        for c, name in names.items()
    ])


def stddevs(df: DataFrame, columns=SECONDS_COLUMNS) -> DataFrame:
    return df.agg(*[F.stddev_samp(c).alias(name) for c, name in _names(columns, "stddev").items()])


def modes(df: DataFrame, columns=CATEGORY_COLUMNS) -> DataFrame:
    """Most frequent value of each column, as text, with its count.

    Null is a value like any other; ties go to the lowest value, null last.
    One scan: cells are counted per (column, value) before the shuffle, and the
    best is a running minimum, so no column is ever sorted or gathered.
    """
    def cell(c):
        # Numbers tie-break as numbers.
        numeric = isinstance(df.schema[c].dataType, T.NumericType)
        return F.struct(
            (F.col(c) if numeric else F.lit(None)).cast("double").alias("number"),
            F.col(c).cast("string").alias("text"),
        ).alias(c)

    counted = (
        df.select(*[cell(c) for c in columns])
        .unpivot([], list(columns), "column_name", "value")
        .groupBy("column_name", "value").agg(F.count("*").alias("num_records"))
    )
    best = F.min(F.struct(
        (-F.col("num_records")).alias("n"), F.col("value.text").isNull().alias("is_null"), "value",
    ))
    return (
        counted.groupBy("column_name").agg(best.alias("best"))
        .select("column_name", F.col("best.value.text").alias("mode"),
                (-F.col("best.n")).alias("num_records"))
    )


# --- marts ----------------------------------------------------------------

def with_times(df: DataFrame, names: dict | None = None, wrap24: bool = False) -> DataFrame:
    """Add an ``HH:mm:ss`` text beside each ``*_sec`` column.

    ``names`` maps a seconds column to the name of its text, by default the
    same name with ``_time`` for ``_sec``, in the case of the column.
    """
    if names is None:
        names = {
            c: c[:-4] + ("_TIME" if c.endswith("_SEC") else "_time")
            for c in df.columns if c.lower().endswith("_sec")
        }
    return df.withColumns({text: format_hms(c, wrap24) for c, text in names.items()})


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def response_counts(df: DataFrame) -> DataFrame:
    """Positive responses counted by all that the response marts group by: stored once, it serves them all."""
    prefixed = df.where(positive(RESPONSE)).withColumn("RADIO_CODE_PREFIX", code_prefix("RADIO_CODE"))
    keys = ["BORO_NM", "NYPD_PCT_CD", "RADIO_CODE_PREFIX", "CIP_JOBS"]
    return count_seconds(prefixed, keys, {"response": RESPONSE})


def area_profile(
    df: DataFrame, keys, accuracy: int | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """Response-time mart of an area: seconds and text, slowest first; from ``response_counts`` if given."""
    if counts is None:
        profile = group_profile(df.where(positive(RESPONSE)), keys, accuracy=accuracy)
    else:
        profile = profile_of_counts(counts, keys)
    return with_times(upper_names(profile)).orderBy(
        F.desc("AVG_RESPONSE_SEC"), *[F.asc_nulls_last(k) for k in keys]
    )


def borough_profile(
    df: DataFrame, accuracy: int | None = None, counts: DataFrame | None = None
) -> DataFrame:
    return area_profile(df, ["BORO_NM"], accuracy, counts)


def precinct_profile(
    df: DataFrame, accuracy: int | None = None, counts: DataFrame | None = None
) -> DataFrame:
    return area_profile(df, ["BORO_NM", "NYPD_PCT_CD"], accuracy, counts)


AREAS = {"borough": ["BORO_NM"], "precinct": ["BORO_NM", "NYPD_PCT_CD"]}


def response_detail(
    df: DataFrame, area: str = "borough", mapping=None, accuracy: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Response time by area, call type and severity, in seconds, unordered.

    The call type follows from the code prefix, so it is looked up once per
    group after the aggregation rather than once per call before it.
    """
    keys = AREAS[area] + ["RADIO_CODE_PREFIX", "CIP_JOBS"]
    stats = ("avg", "median", "min", "max")
    if counts is None:
        prefixed = df.where(positive(RESPONSE)).withColumn(
            "RADIO_CODE_PREFIX", code_prefix("RADIO_CODE")
        )
        profile = group_profile(
            prefixed, keys, stats=stats, count_name="incident_count", accuracy=accuracy
        )
    else:
        profile = profile_of_counts(counts, keys, stats=stats, count_name="incident_count")
    profile = upper_names(profile)
    label = map_code("RADIO_CODE_PREFIX", mapping).alias("TYP_DESC")
    return profile.select(
        *AREAS[area], "RADIO_CODE_PREFIX", label, *profile.columns[len(AREAS[area]) + 1:]
    )


def borough_detail(
    df: DataFrame, mapping=None, accuracy: int | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """Borough detail mart, most calls first."""
    return with_times(response_detail(df, "borough", mapping, accuracy, counts)).orderBy(
        F.desc("INCIDENT_COUNT"),
        *[F.asc_nulls_last(c) for c in ("BORO_NM", "RADIO_CODE_PREFIX", "CIP_JOBS")],
    )


LISTINGS = {"borough": ("BORO_NM",), "type": ("TYP_DESC", "CIP_JOBS")}


def borough_listing(df: DataFrame, by: str, mapping=None, accuracy: int | None = None) -> DataFrame:
    """The borough detail, slowest first within each borough, or within each type and severity."""
    return with_times(response_detail(df, "borough", mapping, accuracy)).orderBy(
        *[F.asc_nulls_last(c) for c in LISTINGS[by]], F.desc("AVG_RESPONSE_SEC"),
        *[F.asc_nulls_last(c) for c in ("BORO_NM", "RADIO_CODE_PREFIX", "CIP_JOBS")],
    )


def precinct_detail(df: DataFrame, mapping=None, accuracy: int | None = None) -> DataFrame:
    return with_times(response_detail(df, "precinct", mapping, accuracy))


ALL_METRICS = {"response": RESPONSE, "dispatch": DISPATCH, "travel": TRAVEL}


def severity_profile(df: DataFrame, accuracy: int | None = None) -> DataFrame:
    """All three durations by severity, fastest first."""
    known = df.where(F.col("CIP_JOBS").isNotNull() & positive(RESPONSE))
    profile = group_profile(
        known, ["CIP_JOBS"], ALL_METRICS, stats=("avg", "median"), accuracy=accuracy
    )
    return with_times(profile).orderBy("avg_response_sec", "CIP_JOBS")


def metric_profile(
    df: DataFrame, keys, name: str, metric: str, accuracy: int | None = None
) -> DataFrame:
    """Profile of one duration over the rows where it is positive, slowest first."""
    return group_profile(
        df.where(positive(metric)), keys, {name: metric}, accuracy=accuracy
    ).orderBy(F.desc(f"avg_{name}_sec"), *[F.asc_nulls_last(k) for k in keys])


def dispatch_profile(df: DataFrame, keys, accuracy: int | None = None) -> DataFrame:
    return metric_profile(df, keys, "dispatch", DISPATCH, accuracy)


def travel_profile(df: DataFrame, keys, accuracy: int | None = None) -> DataFrame:
    return metric_profile(df, keys, "travel", TRAVEL, accuracy)


def borough_by_type(df: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Borough and type code, by type and then slowest first."""
    known = df.where(F.col("TYP_DESC_ENUM").isNotNull() & positive(RESPONSE))
    return group_profile(
        known, ["BORO_NM", "TYP_DESC_ENUM"], stats=("avg", "median"), accuracy=accuracy
    ).orderBy("TYP_DESC_ENUM", F.desc("avg_response_sec"), "BORO_NM")


# --- calendar -------------------------------------------------------------

HOURLY_METRICS = {"response": RESPONSE, "dispatch_delay": DISPATCH, "travel": TRAVEL}

SPLITS = {"non_critical": non_critical, "high_severity": high_severity}


def _by_part(df: DataFrame, part: str) -> DataFrame:
    return calendar_parts(df.where(positive(RESPONSE)), "ADD_TS", [part])


def hourly_profile(df: DataFrame, split: str, metrics=None) -> DataFrame:
    """Average durations by hour for one side of the severity split, hours ascending."""
    metrics = HOURLY_METRICS if metrics is None else metrics
    rows = _by_part(df, "hour_of_day").where(SPLITS[split]())
    profile = group_profile(rows, ["hour_of_day"], metrics, stats=("avg",))
    return with_times(profile).orderBy(F.asc_nulls_last("hour_of_day"))


def calendar_profile(df: DataFrame, part: str, accuracy: int | None = None) -> DataFrame:
    """Response time by ``hour_of_day``, ``month`` or ``day_of_week``."""
    return group_profile(_by_part(df, part), [part], accuracy=accuracy).orderBy(
        F.asc_nulls_last(part)
    )


def hour_cross_profile(df: DataFrame, other: str) -> DataFrame:
    """Average response by hour and a second column, slowest first within the hour.

    Rows without a severity are left out of the severity cross.
    """
    rows = _by_part(df, "hour_of_day")
    if other == "CIP_JOBS":
        rows = rows.where(F.col(other).isNotNull())
    return group_profile(rows, ["hour_of_day", other], stats=("avg",)).orderBy(
        F.asc_nulls_last("hour_of_day"), F.desc("avg_response_sec"), F.asc_nulls_last(other)
    )
