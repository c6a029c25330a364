"""Keyed rows: first-wins duplicates, rows not stored yet, ordered limits, top rows per group.

``row_number() <= k`` is planned with a group limit before the shuffle, so every task sends at most
``k`` rows of a key and a key that holds a third of the table does not pile up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.runtime import materialise, small_side


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of every group, numbered from 1 in ``rank``."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, position).where(F.col(rank) <= k)


def first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first by ``order``."""
    return top_per_group(df, keys, order, 1, "__rank").drop("__rank")


def not_stored(new: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key ``stored`` does not hold.

    The stored table is the large side.  It is first reduced to the keys that collide (a semi join
    the planner can broadcast when the batch is small), so it is never shuffled for a small batch.
    """
    collisions = stored.select(key).join(new.select(key), key, "left_semi")
    return new.join(collisions, key, "left_anti")


def range_parts(df: DataFrame, order: Sequence[Column | str], part: str = "part") -> DataFrame:
    """``df`` written in range partitions by ``order``, numbered in that order in ``part``.

    First pass of a prefix scan: sums and last words are taken per partition, and only these, one row per
    partition, meet in order.
    """
    return materialise(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "parts")


def dense_order(df: DataFrame, order: Sequence[Column | str], name: str = "ord") -> DataFrame:
    """Number all rows 0..n-1 by ``order`` (unique columns) without sorting them in one place.

    Rows are range-partitioned, written down with their partition, and numbered inside it; only the
    partition sizes, one row each, are summed up in order.
    """
    placed = range_parts(df, order, "__part")
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    numbered = placed.withColumn("__row", inside).join(small_side(offsets), "__part")
    return numbered.withColumn(name, F.col("__base") + F.col("__row") - 1).drop("__part", "__row", "__base")


def first_rows(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """Exact global limit in order: a top-n per task, merged; no full sort."""
    return df.orderBy(*order).limit(n)


def normalised_text(text: Column) -> Column:
    """Lower case, white space runs as one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))
