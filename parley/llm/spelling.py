"""Spelling variants: Bloom-guided neighbourhoods of the corpus vocabulary.

Words one edit apart are found by generating edits, not by comparing words.  The vocabulary is put into blocked Bloom
filters, one per word length (an edit only asks the filter of its own length) and segment.  Tasks generate every deletion and
every replacement of a letter by a larger one, ask the broadcast filter, and let only positives go on; an exact join with
the vocabulary removes the false ones.  An insertion is the deletion seen from the longer word, a replacement by a smaller
letter is seen from the other word, so every pair is met once.

What is broadcast is bounded: a segment's filters hold at most ``segment_words`` words at ``bits`` bits each.  A larger
vocabulary is dealt to more segments by a hash, one pass of the generated edits per segment; an edit is asked for in
the one segment it would be in, so the result is the same at any number of segments.

The filters are made of 64-bit words by a grouped ``bit_or``; a key sets one bit in each of four words of one block.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm.tables import Scratch, map_rows
from parley.llm.wordhash import mix

# The letters of a run once A-Z are lower-cased: a-z and U+00C0 to U+00FF, as code points and in UTF-8.
LETTERS = np.concatenate([np.arange(0x61, 0x7B), np.arange(0xC0, 0x100)])
RUN = re.compile(rb"(?:[a-z]++|\xC3[\x80-\xBF])++")
LANES = 4
# Edits of one step of a task, and distinct words a task holds before it passes their counts on.
CELLS, HELD = 1 << 21, 1 << 19

_rng = np.random.default_rng(20250302)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(int(_rng.integers(1, 2**62)) * 2 + 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


@dataclass(frozen=True)
class Spelling:
    """``min_letters`` and ``min_count`` make a word; a form is ``ratio`` times as frequent; every ``slip``-th occurrence loses a letter (0: none)."""

    min_letters: int = 6
    min_count: int = 5
    ratio: int = 5
    slip: int = 199
    bits: int = 16
    segment_words: int = 1 << 22


def vocabulary(docs: DataFrame, rule: Spelling, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: the counted words; each task adds up its own before the shuffle."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("binary").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def drained() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                start = zlib.crc32(f"{key}:".encode())
                for run, n in Counter(RUN.findall((text or b"").lower())).items():
                    word = run.decode()
                    h = zlib.crc32(run, start)
                    if rule.slip and h % rule.slip == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= rule.min_letters:
                        held[word] += n
                if len(held) >= HELD:
                    yield drained()
        if held:
            yield drained()

    counts = rows.where("text is not null").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= rule.min_count)


def _codes(words: list[str], letters: int) -> np.ndarray:
    """Letters of words of one length as a matrix of code points."""
    return np.frombuffer("".join(words).encode("utf-16-le"), np.uint16).reshape(len(words), letters).astype(np.int64)


def _by_length(words: list[str]) -> Iterator[tuple[int, list[str]]]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for letters in np.unique(lengths).tolist():
        yield letters, [words[i] for i in np.flatnonzero(lengths == letters)]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base)]), dtype=np.uint64)


def word_hashes(codes: np.ndarray) -> np.ndarray:
    """Before mixing: a polynomial of the letters, so that an edit's hash follows from the word's."""
    return (_VALUE[codes] * _powers(_BASE, codes.shape[1])[:-1]).sum(axis=1, dtype=np.uint64)


def edits(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Row, place, letter, hash and length of each edit: deletions (letter 0) of the last of equal neighbours, then replacements by larger letters."""
    n, letters = codes.shape
    power, back = _powers(_BASE, letters), _powers(_INVERSE, letters)
    part = _VALUE[codes] * power[:-1]
    sums = np.concatenate([np.zeros((n, 1), np.uint64), np.cumsum(part, axis=1, dtype=np.uint64)], axis=1)
    whole = sums[:, -1]
    for at in range(letters):
        rows = np.arange(n) if at == letters - 1 else np.flatnonzero(codes[:, at] != codes[:, at + 1])
        yield rows, np.full(len(rows), at), np.zeros(len(rows), np.int64), mix(sums[rows, at] + (whole[rows] - sums[rows, at + 1]) * back[1]), letters - 1
    for at in range(letters):
        other = whole[:, None] - part[:, at, None] + (_VALUE[LETTERS] * power[at])[None, :]
        rows, letter = np.nonzero(LETTERS[None, :] > codes[:, at, None])
        yield rows, np.full(len(rows), at), LETTERS[letter], mix(other[rows, letter]), letters


def _split(hashes: np.ndarray, blocks: int, segments: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Segment, block and bit of each lane of a mixed hash; the hash is mixed again for the bits."""
    segment = hashes % np.uint64(segments)
    block = (hashes // np.uint64(segments)) % np.uint64(blocks)
    more = mix(hashes ^ np.uint64(0x9E3779B97F4A7C15))
    return segment, block.astype(np.int64), [(more >> np.uint64(6 * i)) & np.uint64(63) for i in range(LANES)]


class Filters:
    """One segment's filter words, one block range per word length."""

    def __init__(self, first: dict[int, int], blocks: dict[int, int], words: np.ndarray):
        self.first, self.blocks, self.words = first, blocks, words

    def holds(self, hashes: np.ndarray, letters: int, segment: int, segments: int) -> np.ndarray:
        """Numbers of the hashes that may be in the segment's vocabulary of this length."""
        if letters not in self.blocks:
            return np.zeros(0, np.int64)
        left = np.flatnonzero(hashes % np.uint64(segments) == segment) if segments > 1 else np.arange(len(hashes))
        _, block, bits = _split(hashes[left], self.blocks[letters], segments)
        word = (self.first[letters] + block) * LANES
        for lane in range(LANES):
            hit = np.flatnonzero((self.words[word + lane] >> bits[lane]) & np.uint64(1))
            left, word, bits = left[hit], word[hit], [b[hit] for b in bits]
        return left


def _filters(spark: SparkSession, words: DataFrame, sizes: dict[int, int], segment: int, segments: int, rule: Spelling) -> Filters:
    """The segment's filters: bits are or-ed by slot in Spark, at most ``segment_words * bits / 64`` words and a block per length come back."""
    blocks = {letters: max(1, -(-n * rule.bits // (64 * LANES * segments))) for letters, n in sizes.items()}
    first, total = {}, 0
    for letters in sorted(blocks):
        first[letters], total = total, total + blocks[letters]

    def bits(batch):
        for letters, some in _by_length(batch.column("word").to_pylist()):
            own, block, lanes = _split(mix(word_hashes(_codes(some, letters))), blocks[letters], segments)
            mine = np.flatnonzero(own == segment)
            slot = [(first[letters] + block[mine]) * LANES + lane for lane in range(LANES)]
            value = [np.uint64(1) << lanes[lane][mine] for lane in range(LANES)]
            yield [pa.array(np.concatenate(slot)), pa.array(np.concatenate(value).view(np.int64))]

    table = map_rows(words, "slot long, bits long", bits).groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(total * LANES, np.uint64)
    out[table.column("slot").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return Filters(first, blocks, out)


def neighbours(words: DataFrame, rule: Spelling, scratch: Scratch) -> DataFrame:
    """``word, n, near, near_n`` in both directions for words exactly one edit apart; ``words(word, n)`` is a table."""
    spark = words.sparkSession
    # One row per word length that occurs: the longest word bounds them.
    sizes = {r["letters"]: r["n"] for r in words.groupBy(F.length("word").alias("letters")).agg(F.count("*").alias("n")).collect()}
    segments = max(1, -(-sum(sizes.values()) // rule.segment_words))
    # The planner sees few bytes where the work is many edits, so words are dealt to all cores.
    dealt = words.repartition(4 * spark.sparkContext.defaultParallelism, "word").select("word", "n")
    tables = []
    for segment in range(segments):
        held = spark.sparkContext.broadcast(_filters(spark, words, sizes, segment, segments, rule))

        def probe(batch, held=held, segment=segment):
            filters = held.value
            counts = dict(zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()))
            for letters, some in _by_length(list(counts)):
                step = max(1, CELLS // (letters * len(LETTERS)))
                for begin in range(0, len(some), step):
                    part = some[begin : begin + step]
                    for rows, at, letter, hashes, size in edits(_codes(part, letters)):
                        hit = filters.holds(hashes, size, segment, segments)
                        if not len(hit):
                            continue
                        found = [part[i] for i in rows[hit]]
                        made = [
                            w[:a] + (chr(c) if c else "") + w[a + 1 :]
                            for w, a, c in zip(found, at[hit].tolist(), letter[hit].tolist())
                        ]
                        yield [pa.array(found, pa.string()), pa.array([counts[w] for w in found], pa.int64()), pa.array(made, pa.string())]

        positives = map_rows(dealt, "word string, n long, near string", probe)
        known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
        tables.append(scratch.write(positives.join(known, "near").select("word", "n", "near", "near_n"), "pairs"))
        held.destroy()
    pairs = tables[0]
    for table in tables[1:]:
        pairs = pairs.unionByName(table)
    turned = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.unionByName(turned)


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, root`` for ``forms(word, form)``, a table: the last word reached by following forms, which only go up in frequency."""
    state = scratch.write(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = state.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = scratch.write(moved, "roots", state)
        state = moved
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")


def variants(docs: DataFrame, rule: Spelling = Spelling(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` per word of the vocabulary.

    Runs of a-z and U+00C0 to U+00FF, A-Z lower-cased, are the words of a text; an occurrence whose crc32 of ``id:run`` is
    divisible by ``rule.slip`` has lost a letter.  Words have ``min_letters`` letters or more and occur ``min_count`` times or
    more over all rows.  ``n_near`` counts the words exactly one inserted, deleted or replaced letter away; ``form`` is
    the most frequent of them (of equal ones the smallest by code point) if it is ``ratio`` times as frequent as the
    word, else null; ``root`` is the last form reached, the word itself without one.

    A null or empty text has no words, a null id counts as an empty one, rows repeated under one id all count, other
    columns are not looked at, and a table without words gives no rows.  Texts are read whole.
    """
    scratch = Scratch(docs)
    words = scratch.write(vocabulary(docs, rule, id_col, text_col), "vocabulary")
    if words.isEmpty():
        return words.selectExpr("word", "string(null) as form", "word as root", "n", "0L as n_near", "bigint(null) as form_n")
    best = neighbours(words, rule, scratch).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("top")
    )
    best = best.select(F.col("word").alias("near_word"), "n_near", F.col("top.near").alias("form"), (-F.col("top.less")).alias("form_n"))
    joined = words.join(best, words["word"] == best["near_word"], "left")
    enough = F.col("form_n") >= rule.ratio * F.col("n")
    told = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"),
    )
    told = scratch.write(told, "forms", words)
    ends = roots(told.where("form is not null").select("word", "form"), scratch).select(F.col("word").alias("rooted"), "root")
    out = told.join(ends, told["word"] == ends["rooted"], "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
