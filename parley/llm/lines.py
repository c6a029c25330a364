"""Line dedup: normalised lines are hashed, documents counted per hash, and frequent lines dropped but for one document.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased.  Keys of at least
``min_chars`` code points that occur in ``min_docs`` documents lose all their lines except in the largest
id that holds them.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.tables import map_rows, utf8
from parley.runtime import materialise

BLANK = " \t\n\x0b\x0c\r"


def line_key(line: str, min_chars: int) -> bytes | None:
    """128-bit hash of the normalised line, None for one too short to count."""
    stripped = line.strip(BLANK)
    return xxhash.xxh3_128_digest(stripped.encode().lower()) if len(stripped) >= min_chars else None


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` per row; ``text`` is the kept lines in order, joined by a line feed.

    A null or empty text is one empty line.  Rows repeated under one id count as one document and lose the
    same lines.  A row without an id is not counted and keeps its lines.  Every key is counted over whole
    texts of all rows; a key that fills a partition is summed before the shuffle, and its join back is one
    of narrow rows that adaptive execution can split.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def keys(batch):
        ids, held = [], []
        for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            found = {line_key(line, min_chars) for line in (text or "").split("\n")} - {None}
            ids += [i] * len(found)
            held += found
        yield [pa.array(ids, pa.int64()), pa.array(held, pa.binary())]

    held = map_rows(docs.where("doc_id is not null"), "doc_id long, line binary", keys)
    held = materialise(held.distinct(), "lines")
    common = held.groupBy("line").agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper"))
    common = materialise(common.where(F.col("docs") >= min_docs).select("line", "keeper"), "common")
    dropped = held.join(common, "line").where("doc_id <> keeper").groupBy("doc_id").agg(F.collect_list("line").alias("lines"))
    dropped = materialise(dropped.withColumnRenamed("doc_id", "holder"), "dropped")

    def rebuild(batch):
        texts, counts, lost = [], [], []
        for text, lines in zip(batch.column("text").to_pylist(), batch.column("lines").to_pylist()):
            every = (text or "").split("\n")
            kept = every
            if lines:
                gone = set(lines)
                kept = [line for line in every if line_key(line, min_chars) not in gone]
            texts.append("\n".join(kept))
            counts.append(len(every))
            lost.append(len(every) - len(kept))
        yield [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(lost, pa.int64())]

    joined = docs.join(dropped, F.col("doc_id") == F.col("holder"), "left").select("doc_id", "text", "lines")
    return map_rows(joined, "doc_id long, text string, n_lines long, n_dropped long", rebuild)
