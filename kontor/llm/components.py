"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.session import materialise


def _with_smallest(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) with the smallest ``v`` of each ``u``.

    Joined on the node and its hash, so that AQE can split a node with very many neighbours; the
    smallest neighbour itself is combined where the pairs are read.
    """
    smallest = pairs.groupBy("u").agg(F.min("v").alias("m"))
    hashed = F.xxhash64("u").alias("h")
    return pairs.select("u", "v", hashed).join(smallest.select("u", "m", hashed), ["u", "h"])


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``: every node of the edges (a, b) and the smallest node it can reach.

    Each round links larger neighbours to the smallest one known and then does the same among smaller
    neighbours; the number of rounds grows with the logarithm of the longest path. Rounds are written,
    so a lost executor costs at most one of them.
    """
    stars = materialise(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "stars",
    )
    state = None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _with_smallest(both).where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        near = _with_smallest(large)
        small = (
            near.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(near.select("u", F.col("m").alias("v")))
            .distinct()
        )
        stars = materialise(small, "stars")
        found = stars.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38, 0)")).alias("h"),
        ).first()
        if found == state:
            break
        state = found
    roots = stars.select(F.col("v").alias("node")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
