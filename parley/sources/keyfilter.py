"""Key filters kept beside a keyed table: which of its partitions may hold a key.

A filter is a blocked Bloom filter as ordinary rows: every key sets eight bits of one block of 128, found by
its hash, and a block is one row ``(part, blocks, block, low, high)``.  Every append adds a filter for the
keys of each partition it writes, with a number of blocks (a power of two) that fits their count, so filters
grow with the keys and are never resized.  Rows are made by a grouping that combines before the shuffle and
asked by an equality join, so neither side passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Expected keys of a block: 16 bits a key, about one false answer in a thousand.
KEYS_PER_BLOCK = 8
WORD_BITS = 4


def schema(part: T.DataType) -> T.StructType:
    numbers = [T.StructField(name, T.LongType()) for name in ("blocks", "block", "low", "high")]
    return T.StructType([T.StructField("part", part), *numbers])


def _word(hashed: Column, first: int) -> Column:
    """A 64-bit word with up to ``WORD_BITS`` bits set, six bits of the hash for each."""
    word = F.lit(0).cast("long")
    for k in range(first, first + WORD_BITS):
        place = F.shiftrightunsigned(hashed, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        word = word.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return word


def _bits(key: Column) -> tuple[Column, Column]:
    hashed = F.xxhash64(F.lit("bits"), key)
    return _word(hashed, 0), _word(hashed, WORD_BITS)


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def build(rows: DataFrame, key: str, part: str) -> DataFrame:
    """The filters of ``rows``, one for every value of ``part``; rows without a key are left out."""
    keyed = rows.where(F.col(key).isNotNull()).select(F.col(part).alias("part"), F.col(key).alias("key"))
    wanted = F.greatest(F.lit(0), F.ceil(F.log2(F.count("*") / F.lit(KEYS_PER_BLOCK))))
    sizes = keyed.groupBy("part").agg(F.pow(F.lit(2), wanted).cast("long").alias("blocks"))
    low, high = _bits(F.col("key"))
    placed = keyed.join(sizes.withColumnRenamed("part", "of"), F.col("part").eqNullSafe(F.col("of"))).select(
        "part", "blocks", _block(F.col("key"), F.col("blocks")).alias("block"), low.alias("low"), high.alias("high")
    )
    return placed.groupBy("part", "blocks", "block").agg(F.bit_or("low").alias("low"), F.bit_or("high").alias("high"))


def parts_that_may_hold(filters: DataFrame, keys: DataFrame, key: str) -> list:
    """Values of ``part`` (None included) whose filters do not rule out every one of ``keys``.

    Only partition values reach the driver, and the at most 63 filter sizes, which are powers of two.
    """
    sizes = [r[0] for r in filters.select("blocks").distinct().collect()]
    if not sizes:
        return []
    low, high = _bits(F.col("key"))
    probes = keys.select(F.col(key).alias("key")).where("key is not null").distinct()
    probes = probes.select("key", low.alias("l"), high.alias("h"), F.explode(F.array(*map(F.lit, sizes))).alias("blocks"))
    probes = probes.select("l", "h", F.col("blocks").cast("long").alias("blocks"), _block(F.col("key"), F.col("blocks")).alias("block"))
    holds = (F.col("low").bitwiseAND(F.col("l")) == F.col("l")) & (F.col("high").bitwiseAND(F.col("h")) == F.col("h"))
    return [r[0] for r in filters.join(probes, ["blocks", "block"]).where(holds).select("part").distinct().collect()]
