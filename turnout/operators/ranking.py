"""Top-k lists and ranks within groups of a profile."""

from pyspark.sql import DataFrame, Window, functions as F

from turnout.operators.numbering import BY, GROUP, TIES, group_order, rank_groups
from turnout.operators.profiles import response_detail, with_times
from turnout.schema import FASTEST, SLOWEST


def top_k(df: DataFrame, by: str, k: int, ascending: bool = False, ties=()) -> DataFrame:
    """The k rows with the highest (or lowest) value; ties by ``ties`` ascending."""
    first = F.asc_nulls_last(by) if ascending else F.desc_nulls_last(by)
    return df.orderBy(first, *[F.asc_nulls_last(c) for c in ties]).limit(k)


def tags(k: int) -> tuple[str, str]:
    """The tags of the k fastest and of the k slowest rows."""
    return FASTEST.format(k=k), SLOWEST.format(k=k)


def _in_order(df: DataFrame, part, by: str, ties) -> DataFrame:
    return df.orderBy(
        *[F.asc_nulls_last(c) for c in part], "GROUP_ORDER", by, *[F.asc_nulls_last(c) for c in ties],
    )


def top_bottom_k(
    df: DataFrame, part=GROUP, by: str = BY, k: int = 5, ties=TIES, labels=None,
) -> DataFrame:
    """The k fastest and the k slowest rows of each group, tagged; GROUP_ORDER is 0 or 1.

    A group of fewer than 2k rows has rows in both lists.  Each list filters
    its own rank at once, so that Spark limits every group before the shuffle: the form for row
    input.
    """
    labels = labels or tags(k)

    def side(slow: bool) -> DataFrame:
        return (
            df.withColumn("_rank", F.row_number().over(group_order(part, by, ties, slow)))
            .where(F.col("_rank") <= k)
            .drop("_rank")
            .withColumns({
                "GROUP_TYPE": F.lit(labels[int(slow)]), "GROUP_ORDER": F.lit(int(slow)),
            })
        )

    return _in_order(side(False).unionByName(side(True)), part, by, ties)


def top_bottom_of_profile(
    profile: DataFrame, part=GROUP, by: str = BY, k: int = 5, ties=TIES, labels=None,
) -> DataFrame:
    """The same lists of a grouped profile, which is computed and shuffled once.

    Both ranks stand in one row, and a row in both lists comes out twice.
    """
    fast, slow = labels or tags(k)

    def entry(rank, label, place):
        return F.when(F.col(rank) <= k, F.struct(
            F.lit(label).alias("GROUP_TYPE"), F.lit(place).alias("GROUP_ORDER")
        ))

    listed = F.array_compact(F.array(entry("RANK_FAST", fast, 0), entry("RANK_SLOW", slow, 1)))
    ranked = rank_groups(profile, part, by, ties)
    return _in_order(ranked.select(*profile.columns, F.inline(listed)), part, by, ties)


def precinct_ranked(
    df: DataFrame, k: int = 5, mapping=None, accuracy: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Fastest and slowest precincts of each call type and severity, as a mart."""
    detail = response_detail(df, "precinct", mapping, accuracy, counts)
    return with_times(top_bottom_of_profile(detail, k=k)).drop("GROUP_ORDER")
