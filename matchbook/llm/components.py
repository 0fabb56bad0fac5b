"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchbook.llm.store import stored


def _star(pairs: DataFrame, keep) -> DataFrame:
    """Point the neighbours ``v`` of each ``u`` at the smallest of them and ``u``.

    The smallest is found by a grouped minimum and joined back: both sides are plain shuffles, so a node
    with very many neighbours is split by adaptive execution.
    """
    low = stored(pairs.groupBy("u").agg(F.min("v").alias("low")), "low").withColumn("low", F.least("u", "low"))
    return pairs.join(low, "u").where(keep)


def connected(edges: DataFrame) -> DataFrame:
    """(node, component): for each node of an edge (src, dst) the smallest node that it can reach.

    Nodes are non-null longs. Self-loops and repeated edges are allowed; no edges give no rows. The number
    of rounds is logarithmic in the longest path; each round's edges are written to the shared folder.
    """
    own = F.col("src") != F.col("dst")
    now = stored(
        edges.where(own).select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        wide = lambda c: F.sum(c.cast("decimal(20,0)"))  # noqa: E731  (nodes may be any 64-bit number)
        size = now.agg(F.count("*"), wide(F.col("v")), wide(F.xxhash64("u", "v"))).first()
        if size[0] == 0 or size == before:
            break
        before = size
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        large = stored(large, "large")
        moved = _star(large, F.lit(True))
        small = moved.where(F.col("v") != F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        tops = large.groupBy("u").agg(F.min("v").alias("v"))
        now = stored(small.unionByName(tops).distinct(), "small")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
