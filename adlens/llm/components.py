"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge; component is the smallest node reachable.

    Each step replaces a node's edges by edges to its smallest neighbour, so
    the number of edges never grows, and the steps needed grow with the
    logarithm of the nodes.  Every step's edges are written to the shared
    folder, which cuts the lineage.
    """
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    state = _state(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = written(small)
        if (new := _state(now)) == state:
            break
        state = new
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _state(edges: DataFrame) -> tuple:
    """Count and checksum of the edges: equal once a step changes nothing."""
    mixed = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.sum(mixed % 1000003), F.sum(F.shiftright(mixed, 44))).first()
    return tuple(row)
