"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hockeylake.llm.common import intermediates, keep, stash


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that has a link; component is the smallest node reachable.

    Links may repeat, point either way or join a node with itself (no effect); nulls are ignored;
    an empty table gives an empty result. Each round is two group-minimums and two joins whose inputs
    are stashed, so a node with very many links (a group of copies) is split by adaptive execution
    and a lost executor costs one round at most. Rounds go on until nothing changes, about as many
    as the logarithm of the longest chain. Nothing but a row count and a checksum reaches the driver.
    """
    spark = links.sparkSession
    with intermediates(spark):
        edges = stash(
            links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
            .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
            .distinct(),
            "edges",
        )
        before, state = None, () if edges.isEmpty() else (0,)
        while state and state != before:
            before = state
            with intermediates(spark):
                both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
                least = stash(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
                # Large star: every larger neighbour of u is linked with the least of u's neighbourhood.
                large = stash(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct(), "large")
                # Small star: u and its smaller neighbours are linked with the least of them.
                least = stash(large.groupBy("u").agg(F.min("v").alias("m")), "least")
                edges = keep(
                    large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").union(least.select("u", F.col("m").alias("v"))).distinct(),
                    "edges",
                )
            # Stable when every node points at its root and no root points on.
            state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        return keep(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct()), "components")
