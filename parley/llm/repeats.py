"""Substring dedup by seed and extend: passages of ``window`` words that also start earlier in the corpus are cut out.

*Seeds.*  Every text is winnowed (Schleimer et al. 2003): of each ``window - seed + 1`` consecutive ``seed``-word
hashes the smallest is chosen, the last one of equal ones.  The choice depends on the window's words alone, so two
places with the same window share a seed at the same offset, and about one word in seven starts one.

*Joining.*  Seeds that occur once are dropped by a count, the others are joined with their group.

*Extending.*  Two places with one seed hold a common window if, for some ``o``, the ``o`` words to the left and the
``window - seed - o`` words to the right of it agree too.  Places whose whole surroundings (all words a window round the
seed can reach) agree form a class: every place but the first is covered as far as its surroundings reach.  Only the
first place of a class meets the other classes of its seed, one window at a time: the windows round it are counted by
their words.  No pair of places is ever listed, so a passage in a third of all texts costs one row per place.

*Maximal repeats.*  Covered windows that touch or overlap are joined to spans, which are the repeats of at least
``window`` words in their full length.

Keys are 128 bits of two independent hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm import wordhash
from parley.llm.tables import Scratch, map_rows

NO_ID = (1 << 63) - 1
_rng = np.random.default_rng(20250301)
BASES = [np.uint64(int(b) | 1) for b in _rng.integers(1, 2**63, 2, dtype=np.uint64)]


@dataclass(frozen=True)
class Repeats:
    """``window`` words make a repeat; ``seed`` words a seed."""

    window: int = 20
    seed: int = 8

    @property
    def reach(self) -> int:
        """Words on either side of a seed that a window holding it can have."""
        return self.window - self.seed


class Runs:
    """Hashes of runs of words of one block, by running sums."""

    def __init__(self, words: np.ndarray):
        self.sums, self.inverse = [], []
        for base in BASES:
            power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(words), base)]), dtype=np.uint64)
            self.sums.append(np.concatenate([[np.uint64(0)], np.cumsum(words * power[:-1], dtype=np.uint64)]))
            back = np.uint64(pow(int(base), -1, 1 << 64))
            self.inverse.append(np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(words), back)]), dtype=np.uint64))

    def of(self, begin: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
        return wordhash.mix((self.sums[base][end] - self.sums[base][begin]) * self.inverse[base][begin] + (end - begin).astype(np.uint64))


def _words(block: wordhash.Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word of a block; case counts."""
    hashes = wordhash.span_hashes(block.data, block.start, block.end, fold=False)
    return hashes, np.repeat(np.arange(len(block.first) - 1), np.diff(block.first))


def seeds(words: np.ndarray, text: np.ndarray, rule: Repeats) -> np.ndarray:
    """Chosen word places of a block; windows lie within one text."""
    if len(words) < rule.window:
        return np.zeros(0, np.int64)
    places = np.arange(len(words) - rule.seed + 1)
    hashes = Runs(words).of(places, places + rule.seed, 0)
    windows = np.lib.stride_tricks.sliding_window_view(hashes[::-1], rule.reach + 1)[::-1]
    last = np.arange(len(windows)) + rule.reach - windows.argmin(axis=1)
    return np.unique(last[text[: len(windows)] == text[rule.window - 1 : rule.window - 1 + len(windows)]])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _anchors(docs: DataFrame, rule: Repeats) -> DataFrame:
    """``id, tag, pos, seed, around``: every chosen seed, with the hash of its surroundings."""

    def find(batch) -> Iterator[list]:
        ids, tags = batch.column("id").to_numpy(), batch.column("tag").to_numpy()
        for block in wordhash.blocks(batch.column("text").to_pylist()):
            words, text = _words(block)
            at = seeds(words, text, rule)
            if not len(at):
                continue
            runs, own = Runs(words), text[at]
            begin = np.maximum(block.first[own], at - rule.reach)
            end = np.minimum(block.first[own + 1], at + rule.window)
            around = wordhash.mix(runs.of(begin, end, 1) + (at - begin).astype(np.uint64))
            yield [
                pa.array(ids[block.begin + own]), pa.array(tags[block.begin + own]), pa.array((at - block.first[own]).astype(np.int32)),
                _signed(runs.of(at, at + rule.seed, 0)), _signed(around),
            ]

    return map_rows(docs, "id long, tag long, pos int, seed long, around long", find)


def _windows(docs: DataFrame, rule: Repeats) -> DataFrame:
    """``id, tag, pos, one, two``: the windows round the seeds listed in ``tested``."""

    def find(batch) -> Iterator[list]:
        ids, tags, tested = batch.column("id").to_numpy(), batch.column("tag").to_numpy(), batch.column("tested")
        for block in wordhash.blocks(batch.column("text").to_pylist()):
            words, _ = _words(block)
            runs, places, own = Runs(words), [], []
            for t in range(len(block.first) - 1):
                first, n = block.first[t], block.first[t + 1] - block.first[t]
                at = tested[block.begin + t].values.to_numpy()
                starts = np.unique(at[:, None] - np.arange(rule.reach + 1)[None, :])
                starts = starts[(starts >= 0) & (starts + rule.window <= n)]
                places.append(starts + first)
                own.append(np.full(len(starts), t))
            begin, own = np.concatenate(places).astype(np.int64), np.concatenate(own).astype(np.int64)
            yield [
                pa.array(ids[block.begin + own]), pa.array(tags[block.begin + own]), pa.array((begin - block.first[own]).astype(np.int32)),
                _signed(runs.of(begin, begin + rule.window, 0)), _signed(runs.of(begin, begin + rule.window, 1)),
            ]

    return map_rows(docs, "id long, tag long, pos int, one long, two long", find)


def covered(n: int, whole: np.ndarray, starts: np.ndarray, rule: Repeats) -> np.ndarray:
    """Which of ``n`` words are covered by seeds whose surroundings repeat and by repeated windows."""
    begin = np.concatenate([np.maximum(whole - rule.reach, 0), starts])
    end = np.concatenate([np.minimum(whole + rule.window, n), starts + rule.window])
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, begin, 1)
    np.add.at(depth, end, -1)
    return np.cumsum(depth[:-1]) > 0


def cut_repeats(docs: DataFrame, rule: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, n_words, n_removed, spans`` per row: ``text`` is the kept words joined by one space.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  A word goes if a window of ``rule.window`` words covers it whose words
    also start earlier, in a smaller id or before it in the same document, judged on the input.  ``spans`` lists the
    maximal removed runs as ``begin, end`` word numbers, end exclusive.

    A null or empty text has no words and gives an empty text; one shorter than a window loses nothing.  Ids order the
    documents; of rows repeated under one id none comes before another, so equal ones keep the same words.  Rows
    without an id come after all others and are judged among themselves by their start alone.  Other columns are not
    looked at; a table without rows gives none.  Every text is read whole, at any length.
    """
    scratch = Scratch(docs)
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(text).alias("tag"), text.cast("binary").alias("text"),
    )
    long_enough = rows.where(F.length("text") >= 2 * rule.window - 1)
    anchors = scratch.write(_anchors(long_enough, rule), "anchors")

    common = anchors.groupBy("seed").agg(F.count("*").alias("n"), F.min("around").alias("lo"), F.max("around").alias("hi"))
    common = scratch.write(common.where("n > 1").select("seed", (F.col("lo") == F.col("hi")).alias("alone")), "seeds")
    held = scratch.write(anchors.join(common, "seed"), "held", anchors, common)
    first = held.groupBy("seed", "around").agg(F.min(F.struct("id", "pos")).alias("first"))
    first = scratch.write(first, "classes")
    later = F.struct("id", "pos") > F.col("first")
    marked = held.join(first, ["seed", "around"]).select("id", "tag", "pos", "alone", later.alias("later")).where("later or not alone")
    marks = marked.groupBy("id", "tag").agg(
        F.collect_set(F.when(F.col("later"), F.col("pos"))).alias("whole"), F.collect_set(F.when(~F.col("later"), F.col("pos"))).alias("tested")
    )
    marks = scratch.write(marks, "marks", held, first)

    # The first places of classes of one seed meet each other by the words of each window.
    windows = _windows(rows.join(marks.where(F.size("tested") > 0), ["id", "tag"]).select("id", "tag", "text", "tested"), rule)
    windows = scratch.write(windows, "windows")
    first = windows.groupBy("one", "two").agg(F.min(F.struct("id", "pos")).alias("first"), F.max(F.struct("id", "pos")).alias("last"))
    first = scratch.write(first.where(F.col("first") < F.col("last")).drop("last"), "firsts")
    starts = windows.join(first, ["one", "two"]).where(later).groupBy("id", "tag").agg(F.collect_set("pos").alias("starts"))
    nothing = F.array().cast("array<int>")
    plan = marks.where(F.size("whole") > 0).select("id", "tag", "whole", nothing.alias("starts"))
    plan = plan.unionByName(starts.select("id", "tag", nothing.alias("whole"), "starts")).groupBy("id", "tag")
    plan = plan.agg(F.flatten(F.collect_list("whole")).alias("whole"), F.flatten(F.collect_list("starts")).alias("starts"))
    plan = scratch.write(plan, "plan", marks, windows, first)

    def rebuild(batch):
        kept_texts, counts, removed, begins, ends = [], [], [], [], []
        for content, whole, starts in zip(batch.column("text").to_pylist(), batch.column("whole"), batch.column("starts")):
            words = (content or b"").split()
            gone = np.zeros(len(words), bool)
            if whole.is_valid:
                gone = covered(len(words), whole.values.to_numpy(), starts.values.to_numpy(), rule)
            edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)).tolist()
            cuts = [0, *edges, len(words)]
            kept_texts.append(b" ".join(w for a, b in zip(cuts[::2], cuts[1::2]) for w in words[a:b]))
            counts.append(len(words))
            removed.append(int(gone.sum()))
            begins.append(edges[::2])
            ends.append(edges[1::2])
        spans = [pa.array(x, pa.list_(pa.int32())) for x in (begins, ends)]
        texts = pa.array(kept_texts, pa.binary()).cast(pa.string())
        yield [batch.column("doc_id"), texts, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), *spans]

    joined = rows.join(plan, ["id", "tag"], "left").select("doc_id", "text", "whole", "starts")
    schema = "doc_id long, text string, n_words long, n_removed long, begin array<int>, end array<int>"
    kept = map_rows(joined, schema, rebuild)
    return kept.select("doc_id", "text", "n_words", "n_removed", F.arrays_zip("begin", "end").alias("spans"))
