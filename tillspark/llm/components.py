"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.session import staged


def _toward_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Reconnect the neighbours of every node to the least of them and the node itself.

    With ``larger_only`` the neighbours above the node move, otherwise those below it. Only
    the least neighbour is aggregated, so a node with any number of neighbours is no group.
    """
    if larger_only:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("least"))
    joined = near.join(least, "u").withColumn("least", F.least("least", "u"))
    if larger_only:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            joined.select("u", F.col("least").alias("v"))
        )
    return moved.where("u <> v").distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): alternating star contraction.

    Each round is written to the shared folder; the loop ends when a round changes nothing,
    which takes about the logarithm of the longest path. Without links the result is empty.
    """
    edges = staged(links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct(), "edges")
    mark = None
    while True:
        edges = staged(_toward_least(_toward_least(edges, True), False), "edges")
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == mark:
            break
        mark = found
    return (
        edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")))
        .distinct()
    )
