"""Connected components in rounds that write their state to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from parley.runtime import materialise


def _lowest(around: DataFrame) -> tuple[DataFrame, bool]:
    """Smallest neighbour or self per node, and whether the graph is more than stars round their smallest node.

    Combined before the shuffle, and written so that a join with it can be split.
    """
    below, above = F.count_if(F.col("v") < F.col("u")), F.count_if(F.col("v") > F.col("u"))
    lowest = around.groupBy("u").agg(
        F.least(F.min("v"), F.col("u")).alias("m"), ((below > 0) & ((above > 0) | (below > 1))).alias("tangled")
    )
    seen = Observation()
    lowest = materialise(lowest.observe(seen, F.count_if("tangled").alias("tangled")), "lowest")
    return lowest.select("u", "m"), seen.get["tangled"] > 0


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: the smallest node it is connected with.

    Alternating large and small stars (Kiveris et al. 2014).  A hub's edges are joined with one row
    per node read from a table, so adaptive execution splits a hub that fills a partition.  Loops and
    repeated edges are allowed; no edges give no rows.
    """
    state = materialise(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    if state.isEmpty():
        return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for _ in range(max_rounds):
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest, tangled = _lowest(both)
        if not tangled:
            break
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large, "large")
        lowest, _ = _lowest(large)
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(lowest.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        state = materialise(small, "edges")
    else:
        raise RuntimeError("components did not settle")
    roots = state.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
