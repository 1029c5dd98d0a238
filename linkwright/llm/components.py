"""Distributed union-find over an edge table, with DataFrame operations only.

Rounds of large-star and small-star (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014).  Each node sends its least neighbour to the others,
so the number of edges never grows and every step is an aggregate and an equi-join
whose hot keys are combined before the shuffle or split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm.common import checksum, drop, stage


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_least(both), "u")
    return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come with v < u, as _large_star leaves them."""
    joined = edges.join(_least(edges), "u")
    down = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = joined.select("u", F.col("m").alias("v"))
    return down.unionByName(own).where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that an edge names; component is its least node.

    Nulls and edges from a node to itself are left out; repeated edges and either
    direction are fine; without edges the result is empty.
    """
    start = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    cur = stage(start.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(), "edges")
    mark = checksum(cur, "u", "v")
    while mark[0]:
        new = stage(_small_star(_large_star(cur)), "edges")
        drop(cur)
        cur, old, mark = new, mark, checksum(new, "u", "v")
        if mark == old:
            break
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
