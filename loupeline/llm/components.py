"""Connected components of a graph given as edges, by alternating star contractions."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loupeline.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them; edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    return (joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` (the smallest node it is linked to) for every node that has an edge; ``edges`` has columns u and v.

    Every round is written to shared storage. No group is gathered: a node's neighbours meet only in minima and joins.
    """
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now)), "edges")
        after = _state(now)
        if tuple(after) == tuple(state):
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
