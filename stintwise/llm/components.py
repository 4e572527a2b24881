"""Connected components by alternating large and small stars, on edges alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _lowest(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the least of u and all its neighbours.

    The null-safe join keeps its own exchange above the aggregate, so a vertex with very many edges is split.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("least")).select(F.col("u").alias("w"), F.least("w", "least").alias("m"))
    return edges.join(least, edges["u"].eqNullSafe(least["w"])).select("u", "v", "m")


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (longs ``a``, ``b``) that is not the least of its component.

    A round turns every neighbourhood into a star around its least node, first over larger and then over smaller
    neighbours; when a round changes nothing each node hangs on the root of its component.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _lowest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "large-star")
        spread = _lowest(large)
        small = spread.select("u", F.col("m").alias("v")).unionByName(spread.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        now = staged(small.distinct(), "small-star")
        was, state = state, tuple(now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first())
        if was == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
