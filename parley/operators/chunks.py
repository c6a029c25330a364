"""Fixed-width pieces of texts, and of the text a whole topic would make if it were joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.keys import range_parts
from parley.runtime import materialise

# Characters per chunk.
CHUNK_WIDTH = 1024


def _cut(text: Column, width: int) -> Column:
    """Consecutive pieces of ``width`` characters; one linear pass, however long the text."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{width}}}"), F.lit(0))


def chunk_text(df: DataFrame, key: str, text: str, width: int = CHUNK_WIDTH) -> DataFrame:
    """``(key, chunk_no, chunk)``; an empty text has no chunk."""
    return df.select(key, F.posexplode(_cut(F.col(text), width)).alias("chunk_no", "chunk"))


def joined_chunks(
    docs: DataFrame, topic: str, order: str, text: str, width: int = CHUNK_WIDTH, separator: str = " "
) -> DataFrame:
    """``(topic, chunk_no, chunk)`` of every topic's texts joined in order by ``separator``.

    No topic is ever joined: each text learns where it starts, is cut where the chunk borders fall, and the parts
    of one chunk, at most ``width`` characters, are put together.  The starts come from a prefix scan of the lengths over
    range partitions of (topic, order): running lengths inside a partition plus the sums of the topic's partitions
    before, so no window is longer than a partition or than their number, however the order values lie.
    """
    gap = len(separator)
    texts = docs.where(F.col(text).isNotNull()).select(
        F.col(topic).alias("topic"),
        F.col(order).alias("ord"),
        F.col(text).alias("text"),
        (F.length(text).cast("bigint") + gap).alias("span"),
        F.monotonically_increasing_id().alias("row"),
    )
    texts = materialise(texts, "texts")
    # equal order values are told apart by their text, so a repeated run finds the same order
    order_by = ["ord", "tie", "row"]
    spans = range_parts(texts.select("topic", "ord", F.xxhash64("text").alias("tie"), "row", "span"), ["topic", *order_by])
    sums = spans.groupBy("topic", "part").agg(F.sum("span").alias("span"))
    earlier = Window.partitionBy("topic").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("topic", "part", F.coalesce(F.sum("span").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("topic", "part").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.withColumn("within", F.coalesce(F.sum("span").over(inside), F.lit(0))).join(sums, ["topic", "part"])
    placed = texts.join(starts.select("row", "base", "within"), "row")
    at = F.col("base") + F.col("within")
    pieces = placed.select(
        "topic",
        # every text but the first brings the separator in front of it
        F.when(at == 0, F.lit(0)).otherwise(at - gap).alias("at"),
        F.when(at == 0, F.col("text")).otherwise(F.concat(F.lit(separator), "text")).alias("piece"),
    )
    room = (width - F.col("at") % width).cast("int")
    parts = F.concat(
        F.array(F.substring("piece", F.lit(1), room)), _cut(F.substring("piece", room + 1, F.length("piece")), width)
    )
    cut = pieces.select("topic", "at", F.posexplode(parts).alias("nth", "part")).where(F.length("part") > 0)
    in_order = F.array_sort(F.collect_list(F.struct("at", "nth", "part")))
    return (
        cut.withColumn("chunk_no", F.floor(F.col("at") / width).cast("bigint") + F.col("nth"))
        .groupBy("topic", "chunk_no")
        .agg(F.array_join(F.transform(in_order, lambda s: s["part"]), "").alias("chunk"))
    )
