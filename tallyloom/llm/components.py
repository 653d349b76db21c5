"""Connected components by alternating star operations on edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import drop_staged, stage


def components(edges: DataFrame, left: str, right: str, label: str) -> DataFrame:
    """``left, root`` for every node of ``edges``; ``root`` is the least node of its component.

    Large-star links the larger neighbours of each node to its least neighbour, small-star the smaller ones;
    the edge set never grows, and ends as one star per component after O(log n) rounds or so. Neighbour
    minima are aggregates with map-side combine and the joins back are split by AQE where a node is hot.
    Each round is written once; an empty edge set needs no round.
    """
    u, v = F.col("u"), F.col("v")
    now = stage(
        edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where(u != v).distinct(), f"{label}-edges"
    )
    while True:
        if now.isEmpty():
            break
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where(v > u).join(least, "u").select(v.alias("u"), F.col("m").alias("v")).where(u != v).distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(small_least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(v.alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where(u != v)
            .distinct()
        )
        after = stage(small, f"{label}-edges")
        # A star forest: no node has two parents and no parent has a parent.
        parents = after.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        tops = after.select(v.alias("u")).distinct()
        settled = parents.where("n > 1").isEmpty() and after.join(tops, "u", "left_semi").isEmpty()
        drop_staged(now)
        now = after
        if settled:
            break
    roots = now.select(v.alias(left), v.alias("root")).distinct()
    return now.select(u.alias(left), v.alias("root")).union(roots)
