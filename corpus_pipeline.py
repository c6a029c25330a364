"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding; Parquet between the stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parley.llm import stages
from parley.runtime import materialise

STAGES = [
    ("language", stages.language),
    ("near_dedup", stages.near_dedup),
    ("decontamination", stages.decontamination),
    ("source_mix", stages.source_mix),
    ("shards", stages.shards),
]

# Compression, trained or drawn results are not SQL; the tests compare the stages with plain code instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
