"""Integer codes for a category column."""

from pyspark.sql import DataFrame, Window, functions as F

SLICES = 256


def number_values(values: DataFrame, column: str, slices: int = SLICES) -> DataFrame:
    """Sorted position, from 1, of each row of a one-column table of distinct values.

    A window over the whole list would put it into one task.  Here the list is
    cut into slices of neighbouring values, each slice is numbered by itself,
    and the slices start where the ones before end.  The cut points are the
    ``slices - 1`` values with the smallest hash: a fair sample, so slices come
    out even, and the same sample wherever it is computed.  Null sorts first.
    """
    cuts = (
        values.where(F.col(column).isNotNull())
        .orderBy(F.xxhash64(column), column)
        .limit(slices - 1)
        .agg(F.sort_array(F.collect_list(column)).alias("cuts"))
        .scalar()
    )
    below = F.size(F.filter("_cuts", lambda cut: cut <= F.col(column)))
    # Never null, so that the join below filters nothing in front of the distinct list.
    sliced = values.withColumn("_cuts", cuts).select(
        column, F.coalesce(below, F.lit(0)).alias("_slice")
    )
    # At most ``slices`` rows, whatever the table holds.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy("_slice").agg(F.count("*").alias("_size"))
        .select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy("_slice").orderBy(F.asc_nulls_first(column))
    return (
        sliced.withColumn("_row", F.row_number().over(within))
        .join(F.broadcast(starts), "_slice")
        .select(column, (F.col("_start") + F.col("_row")).alias("position"))
    )


def category_codes(
    df: DataFrame, column: str, mode: str = "index", slices: int = SLICES
) -> DataFrame:
    """Code table (``column``, ``code``) of a category column.

    ``index``       0-based position among the sorted non-null values
    ``dense_rank``  1-based rank over all values, null ranking first

    ``slices`` is the number of tasks that number values side by side.
    """
    values = df.select(column).distinct()
    if mode == "index":
        numbered = number_values(values.where(F.col(column).isNotNull()), column, slices)
        return numbered.select(column, (F.col("position") - 1).alias("code"))
    if mode == "dense_rank":
        return number_values(values, column, slices).select(column, F.col("position").alias("code"))
    raise ValueError(f"mode must be 'index' or 'dense_rank', not {mode!r}")


def encode_category(
    df: DataFrame,
    column: str = "TYP_DESC",
    code_column: str | None = None,
    mode: str = "index",
    codes: DataFrame | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """Add the code of a category column; null gets -1 in mode ``index``.

    ``codes`` may be a code table written before.  The join carries no
    broadcast hint: nothing bounds the number of categories, so Spark decides
    by the size it finds (of the stored table, or at run time), and splits a
    frequent category over several tasks where it has to shuffle.
    """
    code_column = code_column or f"{column}_ENUM"
    codes = category_codes(df, column, mode, slices) if codes is None else codes
    lookup = codes.select(F.col(column).alias("_value"), F.col("code").alias(code_column))
    same = F.col(column).eqNullSafe(F.col("_value")) if mode == "dense_rank" else (
        F.col(column) == F.col("_value")
    )
    joined = df.join(lookup, same, "left").drop("_value")
    if mode == "index":
        joined = joined.withColumn(code_column, F.coalesce(code_column, F.lit(-1)).cast("bigint"))
    return joined
