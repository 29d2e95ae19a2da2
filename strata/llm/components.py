"""Connected components by alternating large-star and small-star.

Every round ties each node's larger neighbours to its smallest neighbour
(large-star), then each node's smaller neighbours and itself (small-star); the
edges shrink to stars in a logarithmic number of rounds.  A node's smallest
neighbour is a map-side aggregate and joins back by a merge join, so a hub with
a third of all edges is split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Edges (a, b) of integer nodes -> (node, component): the smallest node reachable.

    Only nodes with an edge to another node appear.  Nulls and loops are
    ignored, repeated edges count once.
    """
    stage = Stage(edges.sparkSession, "components")
    e = edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()
    e = stage.save(e, "edges")
    for i in range(max_rounds):
        if _stars(e):
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(
                e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
        both = e.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionAll(
            e.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        low = stage.save(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"large{i}")
        large = both.join(low.hint("merge"), "u").where("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi"))
        large = stage.save(large.distinct(), f"edges_large{i}")
        low = stage.save(large.groupBy("hi").agg(F.min("lo").alias("m")), f"small{i}")
        small = large.join(low.hint("merge"), "hi")
        e = stage.save(small.select(F.col("m").alias("lo"), F.explode(F.array("hi", "lo")).alias("hi"))
                       .where("lo <> hi").distinct(), f"edges{i}")
    raise RuntimeError("components did not converge")


def _stars(e: DataFrame) -> bool:
    """Whether every node hangs on one smaller node that hangs on none."""
    ends = e.select(F.col("lo").alias("node"), F.lit(0).alias("up")).unionAll(e.select(F.col("hi").alias("node"), F.lit(1).alias("up")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("low")) \
        .where("up > 1 or (up > 0 and low = 0)").isEmpty()
