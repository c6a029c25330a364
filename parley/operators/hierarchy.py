"""Topic hierarchy and layout: the tables behind the two topic charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.operators.components import connected_components
from parley.operators.embedding import reduce_pca

# Similarity thresholds of the levels, finest first.
LEVELS = (0.9, 0.7, 0.5, 0.3, 0.1)


def topic_hierarchy(topics: DataFrame, pairs: DataFrame, levels: Sequence[float] = LEVELS) -> DataFrame:
    """``(level, topic, parent)``: at every level, topics linked by pairs at least that similar
    share the smallest topic of their group as parent.  All levels are grouped in one run."""
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.lit(t).alias("least")) for i, t in enumerate(levels)]))
    node = lambda topic: F.concat_ws("|", F.format_string("%04d", F.col("level")), F.col(topic).cast("string"))
    nodes = topics.select("topic", steps.alias("s")).select("topic", "s.level").withColumn("node", node("topic"))
    linked = pairs.select("topic_a", "topic_b", "similarity", steps.alias("s")).select(
        "topic_a", "topic_b", "similarity", "s.level", "s.least"
    )
    edges = linked.where(F.col("similarity") >= F.col("least")).select(node("topic_a").alias("a"), node("topic_b").alias("b"))
    groups = connected_components(nodes, edges)
    return nodes.join(groups, "node").select(
        "level", F.col("topic").cast("string").alias("topic"), F.expr("substring(component, 6)").alias("parent")
    )


def topic_layout(topics: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(topic, x, y, size)``: topic vectors on their first two principal components."""
    flat = reduce_pca(topics, "topic", "centroid", k=2)
    return flat.join(sizes, "topic").select(
        "topic", F.col("reduced")[0].alias("x"), F.col("reduced")[1].alias("y"), "size"
    )
