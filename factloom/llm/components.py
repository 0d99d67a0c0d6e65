"""Connected components of a link table by alternating large and small stars, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges(a, b) -> (node, component): component is the smallest id reachable, node itself included.

    Only nodes with an edge appear. Null ends and loops are left out. Each round moves every node's
    larger neighbours to its smallest one, then its smaller ones; no node ever gathers its neighbours in
    one row. The minima are combined before the shuffle and the joins can be split, so hubs don't hurt.
    Rounds grow with the logarithm of the longest chain; max_rounds only guards against a defect.
    """
    e = cut(edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct())
    for _ in range(max_rounds):
        # Every tree is a star when no node is both parent and child, and no child has two parents.
        roles = e.select(F.col("lo").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            e.select(F.col("hi").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        mixed = roles.groupBy("node").agg(F.max("up").alias("up"), F.sum("down").alias("down"))
        if mixed.where("down > 1 or (up = 1 and down > 0)").isEmpty():
            break
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = e.join(low, e["lo"] == low["u"], "left").select(F.coalesce("m", "lo").alias("lo"), "hi")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select("m", F.explode(F.array("lo", "hi")).alias("hi")).where("m < hi")
        e = cut(small.select(F.col("m").alias("lo"), "hi").distinct())
    else:
        raise RuntimeError("components: no fixpoint")
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )
