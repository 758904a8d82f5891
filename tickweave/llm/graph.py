"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import store


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, component (the smallest node reachable) of every node of ``edges`` (a, b).

    Each round links the larger neighbours of a node, then its smaller ones, to the smallest
    it knows. Minima are pre-aggregated and joined back, so no neighbour list is ever held;
    each round is written down. Rounds grow with the logarithm of the longest path."""
    both = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = store(both, "edges")
    before = None
    for _ in range(max_rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        # large star: every larger neighbour of u goes to the least of u and its neighbours
        around = now.union(now.select("v", "u"))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # small star: u and its smaller neighbours go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(least.select("u", F.col("m").alias("v"))).distinct()
        now = store(small, "edges")
    else:
        raise RuntimeError("the components did not settle")
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")) \
        .union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
