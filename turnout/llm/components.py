"""Connected components of a table of links, by alternating star contractions."""

from pyspark.sql import DataFrame, functions as F

from turnout.llm.tables import stored


def _stars(edges: DataFrame) -> bool:
    """Whether each link ties a node with no other link to the lowest node of its component."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    )).alias("e")).select("e.*")
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or up = 1 and down = 1").isEmpty()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Tie each node's higher neighbours (``large``) or its lower ones to its lowest neighbour.

    Minima are combined before the shuffle and joined back, so that a node
    with very many links is split like any other hot key.
    """
    if large:
        seen = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        seen = edges.select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        )
    lowest = seen.groupBy("u").agg(F.min("v").alias("m"))
    tied = seen.join(lowest, "u").withColumn("m", F.least("u", "m"))
    if large:
        out = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = tied.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
        )).alias("e")).select("e.u", "e.v")
    return out.where("u <> v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component``, the lowest node reachable, for every node that has a link.

    The number of rounds grows with the logarithm of the longest path.  Each
    round is a stored table; links that are stars already take none.
    """
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u <> v").distinct()
    )
    while not _stars(edges):
        edges = stored(_star(stored(_star(edges, True)), False))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stored(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots))
