"""Connected components by alternating large-star and small-star rounds.

Each round is two joins of the edges with the smallest neighbour of each node
(a partial aggregate, so a hub leaves each task as one row). Every round is
written to the shared folder, which cuts the lineage; the rounds end when a
round leaves the edges as they were. Nothing is collected but two sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written


def _links(df: DataFrame) -> DataFrame:
    return df.where("u <> v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _links(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _links(moved.union(least.select("u", F.col("m").alias("v"))))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (two long columns): the
    component is its smallest node. Nodes without a link do not appear."""
    u, v = edges.columns[:2]
    now, _ = written(_links(edges.select(F.col(u).alias("u"), F.col(v).alias("v"))), "components")
    last = None
    while True:
        now, seen = written(_small_star(_large_star(now)), "components",
                            sum=F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")))
        if (seen["rows"], seen["sum"]) == last:
            break
        last = (seen["rows"], seen["sum"])
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
