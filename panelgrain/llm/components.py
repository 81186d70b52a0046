"""Connected components of an edge table by repeated hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long); all nodes of a component share a root.

    Each round points every node at its neighbour (or itself) of least hash, renames both ends of
    the edges and drops loops; the order by hash makes the number of rounds logarithmic in
    expectation.  Only aggregates and equality joins; each round is written before the next.
    """
    edges = settled(edges.select("u", "v").where(F.col("u") != F.col("v")).distinct())
    roots = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("node"))
        hooks = settled(both.groupBy("u").agg(F.min(rank("v")).alias("best"))
                        .select(F.col("u").alias("node"), F.least(F.col("best"), rank("u"))["node"].alias("parent")))
        if roots is None:
            roots = hooks.select("node", F.col("parent").alias("root"))
        else:
            roots = (roots.join(hooks.withColumnRenamed("node", "root"), "root", "left")
                     .select(roots["node"], F.coalesce("parent", "root").alias("root")))
        roots = settled(roots)
        left = edges.join(hooks.select(F.col("node").alias("u"), F.col("parent").alias("pu")), "u")
        edges = settled(left.join(hooks.select(F.col("node").alias("v"), F.col("parent").alias("pv")), "v")
                        .where(F.col("pu") != F.col("pv"))
                        .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct())
    if roots is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots
