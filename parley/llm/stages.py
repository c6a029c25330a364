"""The corpus pipeline's stages: each takes the rows its predecessor kept and lets its decisions take effect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import decontaminate, langid, mixing, near, sharding
from parley.llm.queries import TARGETS


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` but for the ids of ``gone(gone_id)``; rows without an id stay."""
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the dictionaries can tell."""
    return langid.identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id; repeated rows of an id stay together."""
    verdicts = near.near_duplicates(docs, near.Likeness(words=5))
    return _without(docs, verdicts.where("not kept and doc_id is not null").select(F.col("doc_id").alias("gone_id")).distinct())


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, re-parameterised ones included."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontaminate.contaminated(docs, items).select(F.col("doc_id").alias("gone_id")).distinct())


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn with the raked probabilities."""
    return mixing.drawn(docs, TARGETS).where("mix_kept").select("row.*")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document's shard and place."""
    return sharding.shard_documents(docs)
