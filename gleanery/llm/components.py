"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import checkpointed


def _toward_min(edges: DataFrame) -> DataFrame:
    """edges (u, v) with m, the smallest of u and its neighbours.

    The minimum is combined before the shuffle and joined back, so that a hub's
    edges never have to meet in one group; a hot join key is split by AQE.
    """
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(smallest, "u").withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _toward_min(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    stars = _toward_min(down)
    return stars.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        stars.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (u, v); root is the smallest node reachable.

    Self-loops and repeated edges are ignored; null ends are not allowed. The
    number of rounds grows with the logarithm of the number of nodes.
    """
    edges = checkpointed(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
        if not now[0]:
            break
        edges = checkpointed(_small_star(_large_star(edges).distinct()))
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    return edges.unionByName(roots).toDF("node", "root").distinct()
