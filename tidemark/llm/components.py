"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's neighbours (the larger ones, or the others with itself) to their smallest."""
    pairs = edges if not large else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    linked = pairs.join(smallest, "u")
    if large:
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(smallest.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(edges: DataFrame, folder: str) -> DataFrame:
    """``u, v`` with v the smallest node that u can reach, for every u that is not smallest itself.

    ``edges`` are pairs ``u, v`` of comparable values in any order. Each round writes its edges to
    ``folder`` on shared storage, so a lost executor costs one round at most. The rounds end when
    every node hangs on a smallest one; their number grows with the logarithm of the longest chain.
    """
    now = written(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{folder}/edges-0"
    )
    step = 0
    while True:
        # done once all edges point to roots and each node has one: the stars of a finished forest
        chained = now.join(now.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count()
        forked = now.groupBy("u").count().where("count > 1").limit(1).count()
        if not chained and not forked:
            return now
        step += 1
        now = written(_star(_star(now, large=True), large=False), f"{folder}/edges-{step}")
