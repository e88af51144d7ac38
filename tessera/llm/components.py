"""Connected components of an edge table by alternating large-star and small-star rounds, all in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge: root is the component's smallest node (nodes are longs).

    Rounds end when every edge leads to a root and every other node has one edge; each round's edges are a written table.
    No edges: no rows.
    """
    pairs = stored(_ordered(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    for _ in range(max_rounds):
        # Large star: every larger neighbour of u is tied to the least of u and its neighbours.
        both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _ordered(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        # Small star: u and its smaller neighbours are tied to the least of them.
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(small, "u")
        after = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(tied.select("u", F.col("m").alias("v")))
        after = stored(_ordered(after), "edges")
        # Done when no node hangs from two others, and none is both below another and above one.
        forked = after.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
        if forked.isEmpty() and after.select("v").join(after.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            pairs = after
            break
        pairs = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    leaves = pairs.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return leaves.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _ordered(pairs: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, each once."""
    return pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
