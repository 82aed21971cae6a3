"""Connected components of an edge table, by alternating large and small stars.

Every step is a map-side combined minimum and an equi-join, so no component
is ever gathered in one place; a hub's edges are split by adaptive skew joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.sources.stage_tables import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (a, b) with a > b."""
    if large:  # every larger neighbour moves to the least neighbour
        near = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        out = near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # every smaller neighbour, and the node, move to the least one
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = moved.unionAll(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _unsettled(edges: DataFrame) -> int:
    """Nodes that keep the edges (a, b), a > b, from being a forest of stars: several
    times on the left, or on both sides. One map-side combined count."""
    left = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = left.unionAll(edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").count()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a long, b long) but the roots; root is
    the least node reachable. Nodes without an edge, or only with loops, have no row.

    Logarithmically many rounds, each written as a table, until all are stars.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    while _unsettled(edges):
        edges = materialize(_star(_star(edges, large=True), large=False))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def merged(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root) of groups, as ``components`` returns them, and further edges (a, b):
    only the graph of the groups' roots is solved anew."""
    ends = edges.select("a", "b")
    for end in ("a", "b"):
        of = groups.select(F.col("node").alias(end), F.col("root").alias(f"r{end}"))
        ends = ends.join(of, end, "left").withColumn(f"r{end}", F.coalesce(f"r{end}", end))
    above = components(ends.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    over = above.select(F.col("node").alias("root"), F.col("root").alias("top"))
    moved = groups.join(over, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return materialize(moved.unionAll(above))
