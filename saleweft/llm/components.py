"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import settle


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The smallest node reachable from each node that has a link.

    ``links`` may repeat, may point either way and may link a node to itself; links
    with a null end are ignored. Returns ``node`` and ``component``, one row per node.

    Large-star links each larger neighbour of a node to its smallest neighbour,
    small-star each smaller one; both keep the components and turn them into stars in
    a number of rounds that grows with the logarithm of the longest path. A node's
    smallest neighbour is a combined aggregate, written before it is joined, so a
    hub with very many links meets a plain join whose hot key Spark can split.
    Every round is written to the shared folder, which keeps the lineage short.
    """
    high, low = F.greatest(a, b).alias("high"), F.least(a, b).alias("low")
    edges = settle(links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                   .select(high, low).distinct(), "links")
    nodes = links.select(F.explode(F.array(a, b)).alias("node")).where("node is not null").distinct()
    state = None
    while True:
        edges = _star(edges, both=True)
        edges = _star(edges, both=False)
        found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    labels = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return nodes.join(labels, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"))


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """One star step. Large (``both``): over all neighbours; small: over smaller ones."""
    near = edges.select(F.col("high").alias("u"), F.col("low").alias("v"))
    if both:
        near = near.union(edges.select(F.col("low").alias("u"), F.col("high").alias("v")))
    least = settle(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    linked = near.join(least, "u")
    if both:
        out = linked.where("v > u").select(F.col("v").alias("high"), F.col("m").alias("low"))
    else:
        out = linked.where("v <> m").select(F.col("v").alias("high"), F.col("m").alias("low")).union(
            least.select(F.col("u").alias("high"), F.col("m").alias("low")))
    return settle(out.distinct(), "links")
