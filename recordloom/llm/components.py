"""Connected components of links by alternating stars; no node's links meet in one task's memory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import staged


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``links`` of long columns a and b to (node, component), component being the smallest node.

    Only nodes with a link are returned. Every round hangs each node's larger neighbours on its
    smallest one and then the smaller ones; paths halve, so rounds grow with the logarithm of the
    longest path. Rounds are written tables. Stops when a round changes nothing.
    """
    lo, hi = F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
    edges = staged(links.where("a <> b").select(hi, lo).distinct())
    mark = _mark(edges)
    for _ in range(most_rounds):
        # large star: (u, v) both ways; larger neighbours go to the smallest
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        large = staged(large)
        # small star: smaller neighbours and the node itself go to the smallest
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(least.select("a", F.col("low").alias("b")))
        edges = staged(small.where("a <> b").distinct())
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
