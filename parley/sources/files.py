"""Posts, comments, pairs and lexicons read from files; CSV sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley import schemas


def read_landing(spark: SparkSession, folder: str, schema: T.StructType = schemas.POSTS, fmt: str = "json") -> DataFrame:
    """Everything that has landed, as one batch."""
    return spark.read.schema(schema).format(fmt).load(folder)


def stream_landing(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = schemas.POSTS,
    fmt: str = "json",
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The same folder as a stream; ``glob`` picks files by name."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def read_generated_posts(spark: SparkSession, path: str) -> DataFrame:
    """CSV of generated posts; a leading index column is skipped by name."""
    raw = spark.read.csv(path, header=True, quote='"', escape='"')
    return raw.select(F.to_timestamp("timestamp").alias("timestamp"), "tweet_content")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True, quote='"', escape='"')


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """``(pair_id, reference, generated)`` text pairs from JSON lines."""
    return spark.read.schema("pair_id bigint, reference string, generated string").json(path)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``token, mean valence, ...`` without a header; later columns are ignored."""
    raw = spark.read.schema("token string, valence double").csv(path, sep="\t", quote="", header=False)
    return raw.select(F.lower("token").alias("token"), "valence").where("valence IS NOT NULL")
