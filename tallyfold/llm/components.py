"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (two long columns a, b); root is the least node of the component.

    Each round is staged in the shared folder, so lineage stays short and a lost executor costs one round at most.
    A node with very many links is only ever aggregated, or joined with its one row of minima, which adaptive
    execution splits. Rounds grow with the logarithm of the longest chain. Nothing but two flags reaches the driver.
    """
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct(),
        "links",
    )
    while not _stars(edges):
        edges = stage(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("root").alias("node"), "root").distinct()
    return edges.unionByName(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one root, and no root has another."""
    if not edges.groupBy("node").count().where("count > 1").isEmpty():
        return False
    return edges.select(F.col("root").alias("node")).distinct().join(edges, "node", "left_semi").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Links the larger neighbours of each node to the least of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
    larger = both.where("root > node").join(least, "node")
    return larger.select(F.col("root").alias("node"), F.col("least").alias("root")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links the smaller neighbours of each node, and itself, to the least of them."""
    least = edges.groupBy("node").agg(F.min("root").alias("least"))
    moved = edges.join(least, "node").where("root <> least").select(F.col("root").alias("node"), F.col("least").alias("root"))
    return moved.unionByName(least.select("node", F.col("least").alias("root"))).distinct()
