"""Connected components by alternating large-star and small-star, on DataFrames only.

Kiveris, Lattanzi, Mirrokni, Rastogi, Vassilvitskii: Connected Components in MapReduce and Beyond (2014).
Minima are aggregated before the shuffle, so a node with very many neighbours costs one row a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save


def _minima(directed: DataFrame) -> DataFrame:
    return directed.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    hung = both.join(_minima(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _minima(down)
    others = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Edges (u, v) of longs to rows (node, root): every node of an edge, with the smallest node it reaches.

    Self-loops and repeated edges are allowed; an empty table gives an empty table.
    Stops when a round leaves the edges as they were; the number of rounds grows with the logarithm
    of the longest path, and passing most_rounds raises rather than returning a wrong answer.
    """
    now = save(edges.select("u", "v").where("u <> v").distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        # xor and count together say whether the set of edges is still the same
        seen = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if seen == mark or not seen["n"]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        mark = seen
        now = save(_small_star(_large_star(now)), "edges")
    raise RuntimeError(f"no fixpoint in {most_rounds} rounds")
