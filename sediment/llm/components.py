"""Connected components of an edge table, as rounds of Spark joins with stored results between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import stored


def _towards_smallest(edges: DataFrame, only_smaller: bool) -> DataFrame:
    """Link each node's neighbours to the smallest node among them and itself.

    ``only_smaller`` takes the neighbours below the node (and moves the node itself), else those above it.
    """
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    side = both.where("v < u") if only_smaller else both
    least = side.groupBy("u").agg(F.min("v").alias("m")) if only_smaller else both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    moved = side if only_smaller else both.where("v > u")
    linked = moved.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if only_smaller:
        linked = linked.unionByName(least.select("u", F.col("m").alias("v")))
    return linked.where("u <> v").distinct()


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(u, root) for every node of the undirected ``edges`` (u, v): root is the smallest node it can reach.

    Alternates between linking larger and smaller neighbours to the local minimum until nothing changes, which
    takes about log(n) rounds; at the end each component is a star around its smallest node. Nodes without an
    edge and self-loops are not in the result. Only a count and a check sum reach the driver.
    """
    state = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    current = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = state(current)
    while before[0]:
        current = stored(_towards_smallest(_towards_smallest(current, False), True), "edges")
        after = state(current)
        if after == before:
            break
        before = after
    nodes = current.select("u", F.col("v").alias("root"))
    return nodes.unionByName(current.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct())
