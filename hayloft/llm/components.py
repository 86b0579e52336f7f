"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hayloft.llm.tables import stored


def _state(edges: DataFrame) -> tuple:
    """Fingerprint of an edge set: one row, whatever its size."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.xxhash64("b", "a") % 1000003).alias("s")
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; ``root`` is its component's smallest node.

    Large-star links each larger neighbour of a node to the smallest node it
    sees, small-star does so for the smaller neighbours; both keep components
    and stop when every edge ends at a root. No neighbourhood is gathered: the
    minimum per node is a combined aggregation joined back, so a node with very
    many neighbours splits like any other skewed join key. Each round is written
    to the checkpoint folder. An empty edge table gives an empty result.
    """
    edges = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before = _state(edges)
    while before[0]:
        # large star: over both directions, larger neighbours go to the minimum
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        )
        # small star: every edge points down (a > b); the lower ends go to the lowest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .unionByName(low.select("a", F.col("m").alias("b")))
            .distinct()
        )
        edges = stored(small, "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
