"""Connected components of an edge table by large-star and small-star rounds on shuffled tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackline.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One half round over edges (a, b) with a < b: every node hands its neighbours the smallest node it knows.

    Minima are summed up before the shuffle, and the join back can split a node with very many neighbours.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large \
        else edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("known"))
    least = least.select("node", F.least("node", "known").alias("least"))
    met = both.join(least, F.col("a") == F.col("node"))
    if large:
        moved = met.filter("b > a").select(F.col("least").alias("a"), "b")
    else:
        moved = met.select(F.col("least").alias("a"), "b").unionByName(
            least.select(F.col("least").alias("a"), F.col("node").alias("b")))
    return moved.filter("a <> b")


def _is_done(edges: DataFrame) -> bool:
    """Whether every component is a star: no node is above one node and below another, or below two."""
    sides = edges.select(F.col("a").alias("node"), F.lit(1).alias("above"), F.lit(0).alias("below")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("above"), F.lit(1).alias("below")))
    nodes = sides.groupBy("node").agg(F.max("above").alias("above"), F.sum("below").alias("below"))
    return nodes.filter("below > 1 OR above + below > 1").isEmpty()


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.

    Each round's edges are written to the shared folder. Their number grows with the logarithm of the longest path,
    and a round never gathers the neighbours of a node.
    """
    now = written(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .distinct(), name)
    while not _is_done(now):
        now = written(_star(_star(now, large=True), large=False).distinct(), name)
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
