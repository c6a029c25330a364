"""Near neighbours by random hyperplanes: an index for tables that all pairs are too many for.

Every vector gets, in each of ``tables`` tables, a code of the sides of random hyperplanes it lies on.  Codes are put in
Gray order, so that rows next to each other differ in few sides, and are cut into blocks of ``block`` rows, twice, the
second time half a block later: a row meets at least half a block of rows on either side in every table.  A crowded region, a
third of the table or more, is just more blocks, told apart by further sides; no bucket can grow hot.  Then, one round: the
neighbours a row found, and the rows that found it, meet one another.  Every row is indexed, and equal vectors count as in
``neighbours``; recall is measured against the exact form in the tests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.operators.keys import dense_order, top_per_group
from parley.operators.neighbours import DIGITS, _best, _distances, _matrix, unit
from parley.runtime import materialise

SIDES = 48


def gray_rank(sides: np.ndarray) -> np.ndarray:
    """The place in Gray order of codes given as rows of sides, the most significant first."""
    bits = np.bitwise_xor.accumulate(sides.astype(np.int64), axis=1)
    return bits @ (1 << np.arange(sides.shape[1] - 1, -1, -1, dtype=np.int64))


def codes(vectors: np.ndarray, tables: int, seed: int) -> np.ndarray:
    """One code per vector and table."""
    planes = np.random.default_rng(seed).normal(size=(tables, vectors.shape[1], SIDES))
    return np.stack([gray_rank(vectors @ plane > 0) for plane in planes], axis=1)


def _meet(keys: np.ndarray, v: np.ndarray, wide: int, cosine: bool) -> pd.DataFrame:
    """The ``wide`` nearest of one another, a row itself among them."""
    distance = 1.0 - v @ v.T if cosine else _distances(v, v)
    parts = [(np.repeat(keys[row], len(at)), keys[at], d) for row, at, d in _best(distance, keys, wide)]
    key, neighbour, d = (np.concatenate(c) for c in zip(*parts))
    return pd.DataFrame({"key": key, "neighbour": neighbour, "distance": d})


_FOUND = "key bigint, neighbour bigint, distance double"


def approximate_neighbours(
    df: DataFrame, key: str, vector: str, k: int = 10, metric: str = "cosine", tables: int = 10, block: int = 256, seed: int = 7
) -> DataFrame:
    """``(key, neighbour, distance, rank)``: about the ``k`` nearest other rows of every row.

    Keys are unique whole numbers; vectors have one length.  A null vector has no neighbours and is none.
    """
    if metric not in ("cosine", "euclidean"):
        raise ValueError(f"unknown metric {metric!r}")
    cosine, wide = metric == "cosine", k + 1
    column = unit(F.col(vector)) if cosine else F.transform(vector, lambda x: x.cast("double"))
    rows = df.where(F.col(vector).isNotNull()).select(F.col(key).cast("bigint").alias("key"), column.alias("v"))
    rows = rows.withColumn("vid", F.md5(F.array_join(F.transform("v", lambda x: x.cast("string")), ",")))
    rows = materialise(rows, "vectors")
    # Of a group of copies only the smallest keys can be neighbours.
    sources = materialise(top_per_group(rows, ["vid"], ["key"], wide, "copy"), "sources")
    # Hyperplanes through the middle of the rows tell most apart.
    middle = sources.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("x")).orderBy("i").collect()
    centre = np.array([r["x"] for r in middle])

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                found = codes(_matrix(rows["v"]) - centre, tables, seed)
                at, table = np.indices(found.shape)
                yield pd.DataFrame({"key": rows["key"].to_numpy()[at.ravel()], "t": table.ravel(), "code": found.ravel()})

    placed = dense_order(sources.mapInPandas(coded, "key bigint, t int, code bigint"), ["t", "code", "key"], "pos")
    cuts = F.array(*(F.floor((F.col("pos") + half * (block // 2)) / block) * 2 + half for half in (0, 1)))
    blocks = placed.select("key", "t", F.explode(cuts).alias("block")).join(sources.select("key", "v"), "key")
    together = lambda part: _meet(part["key"].to_numpy(), _matrix(part["v"]), wide, cosine)
    met = blocks.groupBy("t", "block").applyInPandas(together, _FOUND)
    near = materialise(_merged(met, wide), "near")

    # Neighbours of neighbours: a row's list and as many of the rows that list it, nearest first, meet.
    back = top_per_group(near.where("key <> neighbour"), ["neighbour"], ["distance", "key"], wide)
    members = near.select("key", F.col("neighbour").alias("member")).unionByName(back.select(F.col("neighbour").alias("key"), F.col("key").alias("member")))
    members = members.distinct().join(sources.select(F.col("key").alias("member"), "v"), "member")
    lists = members.groupBy("key").agg(F.collect_list(F.struct("member", "v")).alias("m"))

    def refined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for m in rows["m"]:
                yield _meet(np.array([x["member"] for x in m]), np.array([x["v"] for x in m]), wide, cosine)

    near = _merged(near.select("key", "neighbour", "distance").unionByName(lists.select("m").mapInPandas(refined, _FOUND)), wide)
    near = near.join(sources.where("copy = 1").select("key", "vid"), "key")
    lists = near.groupBy("vid").agg(F.array_sort(F.collect_list(F.struct("distance", "neighbour"))).alias("near"))
    others = F.slice(F.filter("near", lambda x: x["neighbour"] != F.col("key")), 1, k)
    return (
        rows.select("key", "vid")
        .join(lists, "vid")
        .select("key", F.posexplode(others).alias("i", "x"))
        .select(
            F.col("key").alias(key),
            F.col("x.neighbour").alias("neighbour"),
            F.col("x.distance").alias("distance"),
            (F.col("i") + 1).alias("rank"),
        )
    )


def _merged(found: DataFrame, wide: int) -> DataFrame:
    """Each row's ``wide`` best of all meetings; a pair that met twice counts once."""
    pairs = found.groupBy("key", "neighbour").agg(F.min(F.round("distance", DIGITS)).alias("distance"))
    return top_per_group(pairs, ["key"], ["distance", "neighbour"], wide)
