"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u > v) -> edges (u > v) of the same components.

    large: every larger neighbour of a node is tied to the node's least neighbour; else every smaller one is.
    """
    if large:
        arcs = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = arcs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = arcs.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # a node's own edge to its minimum comes from that minimum's side, unless the node is larger than it
        return out.unionByName(least.where("m < u").select("u", F.col("m").alias("v"))).distinct()
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    out = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """links (a, b) of longs -> (node, root) for every node that has a link to another; root is the least node.

    Self-links, repeated links and both directions are allowed; links with a null end are ignored. Minima are
    aggregated before they are shuffled, and each round is a table in the shared folder.
    """
    edges = cut(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    seen = None
    for _ in range(MAX_ROUNDS):
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = mark
        edges = cut(_star(_star(edges, large=True), large=False))
    raise RuntimeError(f"the components aren't stable after {MAX_ROUNDS} rounds")
