"""Sharding over fixed virtual slots.

Every record hashes into one of a fixed number of virtual slots.  Bytes are summed per slot, and a stored map
says which shard owns each slot.  The map is a small table with a version: rebalancing edits the owners
of some slots and writes the next version, and records never hash anew.  The law that the map keeps is
``bytes``: shards come out nearly equal in bytes.  A slot overfull with rows of one id (or without one) is
dealt into parts, which are slots of their own in the map.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.runtime import materialise, scratch_path

VIRTUAL_SLOTS = 8192


def virtual_slot(column, slots: int = VIRTUAL_SLOTS):
    """The slot of a record's id; it depends on the id alone."""
    return F.pmod(F.xxhash64(column), F.lit(slots)).cast("int")


def slot_bytes(records: DataFrame) -> dict[int, int]:
    """Bytes per slot of ``records(vslot, size)``: one row per slot reaches the driver."""
    return {r.vslot: r.bytes for r in records.groupBy("vslot").agg(F.sum("size").alias("bytes")).collect()}


def new_map(weights: dict[int, int], shards: int, slots: int = VIRTUAL_SLOTS) -> dict[int, int]:
    """Slot to shard: the heaviest slot first, to the lightest shard."""
    loads = [(0, s) for s in range(shards)]
    heapq.heapify(loads)
    owner = {}
    for slot in sorted(range(slots), key=lambda v: (-weights.get(v, 0), v)):
        load, shard = heapq.heappop(loads)
        owner[slot] = shard
        heapq.heappush(loads, (load + weights.get(slot, 0), shard))
    return owner


def rebalanced(owner: dict[int, int], weights: dict[int, int], shards: int) -> dict[int, int]:
    """The next map: slots move from the heaviest shards to the lightest as long as that evens them out.

    Works for changed weights and for a larger number of shards; all other slots stay where they are.
    """
    owner = dict(owner)
    load = [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in owner.items():
        load[shard] += weights.get(slot, 0)
        held[shard].append((weights.get(slot, 0), slot))
    for slots in held:
        slots.sort()
    while True:
        high, low = max(range(shards), key=lambda s: (load[s], -s)), min(range(shards), key=lambda s: (load[s], s))
        gap = load[high] - load[low]
        moves = [m for m in held[high] if 0 < m[0] < gap]
        if not moves:
            return owner
        best = min(moves, key=lambda m: (abs(gap - 2 * m[0]), m[1]))
        if max(load[high] - best[0], load[low] + best[0]) >= load[high]:
            return owner
        held[high].remove(best)
        held[low].append(best)
        load[high] -= best[0]
        load[low] += best[0]
        owner[best[1]] = low


def save_map(spark: SparkSession, owner: dict[int, int], version: int, path: str) -> None:
    """Write one version of the map; a version is never overwritten."""
    rows = [(version, slot, shard) for slot, shard in sorted(owner.items())]
    spark.createDataFrame(rows, "version int, vslot int, shard int").coalesce(1).write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> dict[int, int]:
    rows = spark.read.parquet(f"{path}/version={version}").select("vslot", "shard").collect()
    return {r.vslot: r.shard for r in rows}


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions stored at ``path``, none if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))


def dealt(rows: DataFrame, weights: dict[int, int], shards: int, slots: int) -> DataFrame:
    """``rows`` with overfull slots dealt into parts of a sixteenth of a shard by row number; at most 16 parts a shard in all."""
    part = max(1, sum(weights.values()) // (16 * shards))
    parts = {s: -(-w // part) for s, w in sorted(weights.items()) if w > 4 * part}
    if not parts:
        return rows
    first, at = {}, slots
    for slot, n in parts.items():
        first[slot], at = at, at + n
    table = lambda values: F.element_at(F.create_map(*(F.lit(x).cast("int") for pair in values.items() for x in pair)), F.col("vslot"))
    moved = table(first) + F.pmod(F.xxhash64("number"), table(parts)).cast("int")
    return rows.withColumn("vslot", F.coalesce(moved, "vslot"))


def stored_map(spark: SparkSession, path: str, weights: dict[int, int], shards: int) -> dict[int, int]:
    """The map to place records by, as read back from ``path``: a first version, or the newest with as few slots moved as ``weights`` ask for."""
    slots = max(weights, default=0) + 1
    known = versions(spark, path)
    if known:
        old = load_map(spark, path, known[-1])
        missing = {s: s % shards for s in range(slots) if s not in old}
        owner, version = rebalanced({**old, **missing}, weights, shards), known[-1] + 1
        if owner == old:
            return old
    else:
        owner, version = new_map(weights, shards, slots), 1
    save_map(spark, owner, version, path)
    return load_map(spark, path, version)


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, vslot``: UTF-8 bytes of the text (null: none) plus 8, and its checksum."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    ).withColumn("vslot", virtual_slot("doc_id", slots))


def placed(rows: DataFrame, owner: dict[int, int]) -> DataFrame:
    """Add ``shard`` and ``slot``, a record's place in its shard, without gaps from 0.

    Places are numbered per virtual slot and shifted by the rows of the shard's earlier virtual slots, so
    no task orders a whole shard.  Ties of the id go by size and checksum; equal rows are interchangeable.
    A null id hashes like any other value.  The map and the row counts are bounded by the number of slots.
    """
    counts = {r.vslot: r.n for r in rows.groupBy("vslot").agg(F.count("*").alias("n")).collect()}
    filled = dict.fromkeys(owner.values(), 0)
    table = []
    for vslot in sorted(owner):
        table.append((vslot, owner[vslot], filled[owner[vslot]]))
        filled[owner[vslot]] += counts.get(vslot, 0)
    table = rows.sparkSession.createDataFrame(table, "vslot int, shard int, before long")
    order = Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32", "number")
    numbered = rows.withColumn("place", F.row_number().over(order) - 1)
    return numbered.join(F.broadcast(table), "vslot").withColumn("slot", F.col("before") + F.col("place")).drop("before", "place")


def shard_documents(docs: DataFrame, shards: int = 24, slots: int = VIRTUAL_SLOTS, maps: str | None = None, **columns: str) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot`` per row.

    The map is stored and read at ``maps``, by default a folder of its own in the shared one: there a first version is
    written, where one is stored it is edited and the next version written if anything moved.  A null text has no bytes;
    rows under a repeated or null id are records each, and a slot overfull with them is dealt into parts, so one id may
    hold any share of the rows.  Equal rows are interchangeable.  Empty tables give no rows; other columns are not read,
    whatever their names.  ``grown_shard`` is null, for under the law ``bytes`` a larger number of shards is a matter of
    ``rebalanced``.
    """
    spark = docs.sparkSession
    # Written once, so that every later pass sees the same row numbers.
    rows = materialise(records(docs, slots=slots, **columns).withColumn("number", F.monotonically_increasing_id()), "records")
    rows = dealt(rows, slot_bytes(rows), shards, slots)
    weights = {**dict.fromkeys(range(slots), 0), **slot_bytes(rows)}
    owner = stored_map(spark, maps or scratch_path(spark, "maps"), weights, shards)
    return placed(rows, owner).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("vslot").alias("virtual_slot"),
    )
