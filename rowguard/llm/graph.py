"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowguard.llm.common import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _stars(edges: DataFrame, only_smaller: bool) -> DataFrame:
    """One round: neighbours of each node are tied to the least of them instead."""
    near = _both_ways(edges)
    if only_smaller:
        near = near.filter("v < u")
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    tied = near.join(least, "u")
    if only_smaller:
        kept = tied.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = kept.unionByName(least.select("u", F.col("m").alias("v")))
    else:
        new = tied.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return new.filter("u <> v").distinct()


def _done(edges: DataFrame) -> bool:
    """Each node has one edge to a smaller one, or is the centre of a star, but not both."""
    up = edges.select(F.col("u").alias("node"), F.lit(1).alias("ups"), F.lit(0).alias("downs"))
    down = edges.select(F.col("v").alias("node"), F.lit(0).alias("ups"), F.lit(1).alias("downs"))
    node = up.unionByName(down).groupBy("node").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs"))
    return edges.filter("u < v").isEmpty() and node.filter("ups + downs > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the least node of its component, for every node of ``edges`` (u, v).

    Alternates large and small stars until each component is a star around its least node, some logarithm of the longest path in
    rounds. Minima are taken before they are shuffled and joined back, so a node may have any number
    of neighbours. Every round is written to the shared folder. Null ends are left out.
    """
    edges = written(edges.select("u", "v").filter("u <> v").distinct(), "components-edges")
    while not _done(edges):
        edges = written(_stars(_stars(edges, False), True), "components-round")
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return ends.unionByName(edges.select("v", F.col("v").alias("label")).toDF("node", "label").distinct())
