"""Numbers of rows within their groups."""

from pyspark.sql import DataFrame, Window, functions as F

GROUP = ("TYP_DESC", "CIP_JOBS")
BY = "AVG_RESPONSE_SEC"
TIES = ("BORO_NM", "NYPD_PCT_CD", "RADIO_CODE_PREFIX")


def group_order(part, by, ties, slow: bool):
    first = F.desc_nulls_last(by) if slow else F.asc_nulls_first(by)
    return Window.partitionBy(*part).orderBy(first, *[F.asc_nulls_last(c) for c in ties])


def rank_groups(df: DataFrame, part=GROUP, by: str = BY, ties=TIES) -> DataFrame:
    """Rank every row within its group, fastest first and slowest first; a group is one task's.

    ``ranks_in_slices`` is the form for groups too large for that.
    """
    return df.withColumns({
        "RANK_FAST": F.row_number().over(group_order(part, by, ties, slow=False)),
        "RANK_SLOW": F.row_number().over(group_order(part, by, ties, slow=True)),
    })


#: Ranks that one percentile sketch of a group may be off.
CUT_ACCURACY = 1000


def ranks_in_slices(
    df: DataFrame, part=GROUP, by: str = BY, ties=TIES, slices: int = 64
) -> DataFrame:
    """The ranks of ``rank_groups``, with a group's rows spread over as many as ``slices`` tasks.

    Each group has cut points of its own, percentiles of ``by`` from a mergeable sketch, and a slice is what
    lies between two of them; rows of one value stay together, null is a slice of its own.  Rows are
    numbered within their slice, and the sizes of the slices before it (behind it, for the slowest) are
    added.  The ranks are bigint.
    """
    fractions = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    cuts = df.groupBy(*part).agg(
        F.percentile_approx(by, fractions, CUT_ACCURACY).alias("_cuts")
    ).select(F.struct(*part).alias("_of_part"), "_cuts")
    below = F.size(F.filter("_cuts", lambda cut: cut < F.col(by)))
    # By one struct, in which nulls are equal; and rows are dealt by group and slice, not by group.
    sliced = (
        df.withColumn("_part", F.struct(*part)).join(cuts, F.col("_part") == F.col("_of_part"))
        .withColumn("_slice", F.when(F.col(by).isNull(), -1).otherwise(below)).drop("_part", "_of_part", "_cuts")
    )
    whole = Window.partitionBy(*part).orderBy("_slice")
    starts = sliced.groupBy(*part, "_slice").agg(F.count("*").alias("_size")).select(
        F.struct(*part, "_slice").alias("_of_slice"),
        *[F.coalesce(F.sum("_size").over(whole.rowsBetween(*rows)), F.lit(0)).alias(name) for name, rows in (
            ("_before", (Window.unboundedPreceding, -1)), ("_behind", (1, Window.unboundedFollowing)))],
    )
    own = [*part, "_slice"]
    return (
        rank_groups(sliced, own, by, ties).withColumn("_slice_of", F.struct(*own))
        .join(starts, F.col("_slice_of") == F.col("_of_slice"))
        .select(*df.columns, (F.col("RANK_FAST") + F.col("_before")).alias("RANK_FAST"),
                (F.col("RANK_SLOW") + F.col("_behind")).alias("RANK_SLOW"))
    )
