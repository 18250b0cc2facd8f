"""Connected components by alternating large and small stars, all in joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.llm.common import stored


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    far = both.where("v > u").join(_least(both), "u")
    return far.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = _least(down)
    near = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns u, v); root is the least node.

    Each round is stored, so lineage stays short. The rounds end when a round leaves
    the set of stars as it was; a graph of n nodes needs about log n of them.
    """
    state = stored(edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))
                   .where("u <> v").distinct(), "edges")
    mark = None
    for _ in range(rounds):
        state = stored(_small_star(_large_star(state)), "stars")
        seen = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
