"""Connected components of a large edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.session import durable


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the least of node and neighbours."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them; u is over v in each edge."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return (
        edges.join(least, "u")
        .select(F.when(F.col("v") == F.col("least"), F.col("u")).otherwise(F.col("v")).alias("u"),
                F.col("least").alias("v"))
        .where("u != v")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v); the root is the least node reachable.

    Each round writes its edges to the shared work folder, so a lost executor costs
    one round at most. Rounds go with the logarithm of the longest path. Self links
    and repeated edges are harmless, rows with a null end are ignored, and no edges
    give no rows.
    """
    current = durable(
        edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    while True:
        after = durable(_small_star(_large_star(current)), "links")
        sums = [
            e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
            for e in (current, after)
        ]
        if sums[0] == sums[1]:
            break
        current = after
    roots = after.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(after.select("v", "v").distinct())
