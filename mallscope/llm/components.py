"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallscope.llm.common import written


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """node and root (the smallest node it is linked to) of every node that has
    an edge; ``edges`` has the columns ``a`` and ``b`` of one orderable type.

    Large-star and small-star rounds (Kiveris et al., 2014): first every node's
    larger neighbours are hung on its smallest one, then its smaller ones. A
    round only aggregates minima and joins them back; edges are written to the
    shared folder after each, and the end is seen from their count and a hash
    sum alone. The number of rounds grows with the logarithm of the longest
    chain.
    """
    e = written(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
                 .filter("hi > lo").distinct())
        large = written(large, "large-star")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        hung = large.join(least, "hi")
        small = (hung.select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .union(least.select("hi", F.col("m").alias("lo"))).filter("hi > lo").distinct())
        e = written(small, "small-star")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
