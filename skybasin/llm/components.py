"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skybasin.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) for every id in ``links`` (a, b).

    Each round moves every node closer to the smallest of its component; the rounds needed grow
    with the logarithm of the number of nodes.  Rounds are written tables; nothing but a count reaches
    the driver.  A node with very many links costs a partial aggregate per task
    and a join whose large partitions adaptive execution splits.  Null ids and links of an id to
    itself are ignored.  No links give no rows.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u > v AND a IS NOT NULL AND b IS NOT NULL")
        .distinct(),
        "links",
    )
    while not _stars(edges):
        edges = stored(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )


def _stars(edges: DataFrame) -> bool:
    """Whether every node is either linked to one smaller node or linked to by larger ones: then the smaller is the smallest."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter("up + down > 1").agg(F.count("*")).head()[0] == 0


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("v", "u"))
    lowest = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(lowest, "u")
        .filter("v > u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(lowest, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(lowest).distinct()
