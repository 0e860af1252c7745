"""Connected components of a table of links, in rounds of joins.

Large-star and small-star rounds hang every vertex below smaller ones until each
hangs directly below the smallest of its component. Minima are combined before
they are shuffled, and the joins read their shuffles directly, so adaptive
execution may split a vertex that has very many links. Each round is a written
table; the driver sees a count and a checksum, which the writing job works out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetschema.staging import stage, stage_observed


def _signed(edges: DataFrame, label: str) -> tuple[DataFrame, tuple[int, int]]:
    """The written edges, how many there are and the sum of their hashes."""
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    edges, seen = stage_observed(edges, label, n=F.count(F.lit(1)), total=total)
    return edges, (int(seen.get("n") or 0), int(seen.get("total") or 0))


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(vertex, component): for every vertex of a link the smallest vertex it can reach.

    Links may repeat, stand either way round or join a vertex with itself; links
    with a NULL end count for nothing. No links give no rows. A vertex without a
    link to another one is not in the result.
    """
    a, b = F.col(left), F.col(right)
    edges = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges, now = _signed(edges, "links")
    before = None
    while now != before:
        # every neighbour that is larger hangs below the smallest neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        edges = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = stage(edges.distinct(), "large-star")
        # every smaller neighbour, and the vertex, hang below the smallest
        low = edges.groupBy("u").agg(F.min("v").alias("low"))
        moved = edges.join(low, "u").where(F.col("v") != F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        before = now
        edges, now = _signed(moved.unionByName(low.withColumnRenamed("low", "v")).distinct(), "small-star")
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(
        edges.select("v").distinct().select(F.col("v").alias("vertex"), F.col("v").alias("component"))
    )
