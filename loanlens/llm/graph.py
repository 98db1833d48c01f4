"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node (u > v in every edge) and its smaller neighbours are linked to the smallest one."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every node of ``edges`` (u, v: long), component its smallest node.

    Alternating large-star and small-star steps, each an aggregate and a join; the edges
    of every round are written, so a lost executor costs one round. The rounds grow with
    the logarithm of the longest chain. A node with many links is one row of the small
    side of the join; its links are split by Spark's skew join. Links to oneself, repeated
    links and an empty table are allowed; nulls are not.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = cut_lineage(edges.where("u <> v").distinct())
    state = None
    while True:
        # A star forest stays as it is; the checksum of the edges tells.
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == state or row[0] == 0:
            break
        state = tuple(row)
        edges = cut_lineage(_small_star(_large_star(edges)))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
