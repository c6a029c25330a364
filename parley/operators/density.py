"""Density clusters over the neighbour graph: whole vectors, however many dimensions.

A point's core distance is that to its ``min_points``-th neighbour.  Two neighbours are linked at the larger of
their distance and both core distances (mutual reachability, Campello et al. 2013), and links up to ``radius`` make clusters:
the cut of the density tree at that level, for which the linked components are enough.  Points only meet the neighbours
they have, so the graph has ``k`` edges a point; copies of one vector are neighbours like any others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.operators.components import connected_components
from parley.operators.terms import renumber
from parley.runtime import materialise


def reachability(neighbours: DataFrame, key: str, min_points: int) -> DataFrame:
    """``(a, b, reach)`` per neighbour pair, from ``(key, neighbour, distance, rank)``; a point with fewer neighbours is never dense."""
    core = neighbours.where(F.col("rank") == min_points).select(F.col(key).alias("point"), F.col("distance").alias("core"))
    core = materialise(core, "core")
    side = lambda name: core.select(F.col("point").alias(name), F.col("core").alias(f"core_{name}"))
    pairs = neighbours.select(F.col(key).alias("a"), F.col("neighbour").alias("b"), "distance")
    pairs = pairs.join(side("a"), "a").join(side("b"), "b")
    return pairs.select("a", "b", F.greatest("distance", "core_a", "core_b").alias("reach"))


def density_clusters(
    points: DataFrame, neighbours: DataFrame, key: str, radius: float, min_points: int = 5, min_cluster_size: int = 10
) -> DataFrame:
    """``(key, topic)``: 0, 1, ... by falling size, ``-1`` for outliers.

    ``neighbours`` is ``(key, neighbour, distance, rank)`` with at least ``min_points`` ranks, exact or from an index.  Points
    without a link up to ``radius``, and clusters of fewer than ``min_cluster_size`` points, are outliers.
    """
    links = materialise(reachability(neighbours, key, min_points).where(F.col("reach") <= radius).select("a", "b"), "links")
    nodes = links.select(F.explode(F.array("a", "b")).alias("node"))
    component = materialise(connected_components(nodes, links), "components")
    sizes = component.groupBy(F.col("component").alias("topic")).agg(F.count("*").alias("size"))
    numbered = renumber(sizes.where(F.col("size") >= min_cluster_size))
    topics = numbered.select(F.col("topic").alias("component"), F.col("topic_id").alias("topic"))
    placed = component.join(topics, "component").select(F.col("node").alias(key), "topic")
    return points.select(key).join(placed, key, "left").select(key, F.coalesce("topic", F.lit(-1)).cast("int").alias("topic"))
