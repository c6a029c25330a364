"""Reply trees: depth and root of every comment by pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.runtime import materialise


def flatten_threads(replies: DataFrame, node: str = "id", parent: str = "parent_id", max_rounds: int = 64) -> DataFrame:
    """``(node, root, depth)`` for a forest given as node and parent id (NULL at a root).

    Every round doubles the distance each pointer spans, so a thread of depth d takes log2(d)
    rounds.  Nodes that reached their root leave the join, and with them the hot keys: only
    unfinished pointers are looked up, against one row per node.
    """
    known = replies.select(F.col(node).alias("__known"))
    up = (
        replies.select(F.col(node).alias("node"), F.col(parent).alias("up"))
        .join(known, F.col("up") == F.col("__known"), "left")
        .select(
            "node",
            F.coalesce("__known", "node").alias("root"),
            F.when(F.col("__known").isNull(), 0).otherwise(1).alias("depth"),
        )
    )
    state = materialise(up.withColumn("done", F.col("depth") == 0), "threads")
    for _ in range(max_rounds):
        pending = state.where(~F.col("done"))
        if pending.isEmpty():
            return state.select(F.col("node").alias(node), "root", "depth")
        hop = state.select(
            F.col("node").alias("root"),
            F.col("root").alias("next"),
            F.col("depth").alias("more"),
            F.col("done").alias("ends"),
        )
        stepped = pending.join(hop, "root").select(
            "node",
            F.col("next").alias("root"),
            (F.col("depth") + F.col("more")).alias("depth"),
            F.col("ends").alias("done"),
        )
        state = materialise(state.where("done").unionByName(stepped), "threads")
    raise ValueError("reply chain is cyclic")
