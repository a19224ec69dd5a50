"""Connected components of an edge list by alternating large and small stars."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlens.llm.common import checkpointed


def _least(edges: DataFrame) -> DataFrame:
    """(n, least): the smallest among a node and its neighbours."""
    return edges.groupBy(F.col("u").alias("n")).agg(F.least(F.min("u"), F.min("v")).alias("least"))


def _stars(edges: DataFrame) -> DataFrame:
    """One round: hang larger neighbours, then smaller ones, on the least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = (both.join(_least(both), F.col("u") == F.col("n")).filter(F.col("v") > F.col("u"))
             .select(F.col("v").alias("u"), F.col("least").alias("v")).distinct())
    down = large.filter(F.col("u") > F.col("v"))
    least = _least(down)
    small = down.join(least, F.col("u") == F.col("n"))
    return (small.select(F.col("v").alias("u"), F.col("least").alias("v"))
            .unionByName(least.select(F.col("n").alias("u"), F.col("least").alias("v")))
            .filter(F.col("u") != F.col("v")).distinct())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, v) edges to (node, root): every node of an edge with the least node it reaches.

    Self-loops and repeated edges are allowed; the roots stand in the result too.
    """
    state = checkpointed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                         .filter(F.col("u") != F.col("v")).distinct())
    seen = None
    for _ in range(max_rounds):
        mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            roots = state.select(F.col("v").alias("node")).distinct()
            return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                roots.select("node", F.col("node").alias("root")))
        seen, state = mark, _stars(state).checkpoint()
    raise RuntimeError("the components did not settle")
