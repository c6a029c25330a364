"""Benchmark decontamination by templates.

A text becomes a sequence of template tokens: words in lower case without outer punctuation, and typed
placeholders for numbers, units after a number, and names (capitalised words inside a sentence, a run of
them as one).  Windows of template tokens are hashed and joined with the benchmark's windows.  Windows
that line up with an item at one offset are an alignment; what stands in the item's slots must map to one
filling each, or only the windows count whose slots are filled as in the item.  A document is contaminated
by an item if ``least_windows`` windows of an alignment hold, or all windows of a shorter item.

An item with windows of too few words, dense in slots or short, would match by its form alone.  Such an item
is also cut into windows of its words as they stand, numbers and names included, so that copies are found.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm import wordhash
from parley.llm.tables import map_rows, utf8
from parley.runtime import materialise

# Units of measure, money and time that may follow a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb oz ml cl l gal s sec min h hr d day days week weeks month months year years hour hours "
    "minute minutes second seconds meter meters metre metres kilometer kilometers mile miles inch inches foot feet gram grams "
    "kilogram kilograms liter liters litre litres dollar dollars euro euros cent cents usd eur percent degree degrees"
).split()
NUMBER, UNIT, NAME = 1, 2, 3
BITMAP_BITS = 24
LITERAL = 1 << 32  # added to the length in the hash of a window of words as they stand

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[33, 46, 58, 63]] = True


@dataclass(frozen=True)
class Template:
    """``window`` template tokens, ``least_literals`` of them words; ``least_windows`` in line are a leak.

    Items shorter than a window are one window.  Windows of fewer words count word for word only, and an item of
    fewer than ``least_literals`` words and slots is only found in a text that holds nothing else.
    """

    window: int = 8
    least_literals: int = 5
    least_windows: int = 6


def _fingerprint(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    return wordhash.span_hashes(data, ends - [len(w) for w in words], ends)


_UNIT_HASHES = _fingerprint(UNITS)


def _words(block: wordhash.Block) -> tuple[np.ndarray, ...]:
    """Words of a block without outer punctuation, slots included: text, first and last byte and hash of each."""
    data, n = block.data, len(block.data)
    alnum = _ALNUM[data]
    place = np.arange(n)
    following = np.minimum.accumulate(np.where(alnum, place, n)[::-1])[::-1]
    preceding = np.maximum.accumulate(np.where(alnum, place, -1))
    text = np.repeat(np.arange(len(block.first) - 1), np.diff(block.first))
    begin = following[block.start]
    keep = begin < block.end
    begin, text, word_end = begin[keep], text[keep], block.end[keep]
    end = preceding[word_end - 1] + 1
    return text, begin, end, wordhash.span_hashes(data, begin, end)


def tokens(block: wordhash.Block, words: tuple[np.ndarray, ...] | None = None) -> tuple[np.ndarray, ...]:
    """Template tokens of a block: text, first and last byte, kind (0 for a word) and hash of each."""
    data, n = block.data, len(block.data)
    text, begin, end, hashes = words or _words(block)

    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    number = digits[end] > digits[begin]
    first = np.ones(len(text), bool)
    first[1:] = text[1:] != text[:-1]
    after_number = np.zeros(len(text), bool)
    after_number[1:] = number[:-1]
    unit = after_number & ~first & ~number & np.isin(hashes, _UNIT_HASHES)
    # A sentence begins at a text, after a stop, or on a new line.
    breaks = np.concatenate([[0], np.cumsum((data == 10) | _STOP[data])])
    opens = first.copy()
    opens[1:] |= breaks[begin[1:]] > breaks[end[:-1]]
    second = data[np.minimum(begin + 1, n - 1)]
    capital = (data[begin] >= 65) & (data[begin] <= 90) & ~((second >= 65) & (second <= 90))
    capital |= (data[begin] == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    name = capital & ~opens & ~number & ~unit
    kind = np.select([number, unit, name], [NUMBER, UNIT, NAME], 0)
    hashes = np.where(kind > 0, wordhash.mix(kind.astype(np.uint64) + np.uint64(1 << 40)), hashes)
    # A run of names is one token.
    again = np.zeros(len(text), bool)
    again[1:] = name[1:] & name[:-1] & ~first[1:]
    head = np.flatnonzero(~again)
    tail = np.append(head[1:], len(text))[: len(head)] - 1
    return text[head], begin[head], end[tail], kind[head], hashes[head]


def _windows(hashes: np.ndarray, text: np.ndarray, length: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Places whose ``length`` tokens lie in one text, and the hashes of these windows."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, np.int64), hashes[:0]
    at = np.flatnonzero(text[:count] == text[length - 1 :])
    out = np.full(len(at), length + salt, np.uint64)
    for j in range(length):
        out = wordhash.mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[at + j])
    return at, out


def _fillings(data: np.ndarray, begin: np.ndarray, end: np.ndarray, kind: np.ndarray, at: int, length: int) -> list[str]:
    """What stands in the slots of a window, in lower case."""
    places = at + np.flatnonzero(kind[at : at + length])
    return [" ".join(bytes(data[begin[p] : end[p]]).decode(errors="replace").lower().split()) for p in places]


def benchmark_windows(items: DataFrame, how: Template, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, literal, item_pos, item_windows, length, hash, item_slots``: every window with enough words.

    Items with other windows, too, have all windows of their words as ``literal`` ones.
    """

    def cut(batch):
        ids = batch.column("item_id").to_pylist()
        for block in wordhash.blocks(batch.column("text").to_pylist()):
            words = _words(block)
            text, begin, end, kind, hashes = tokens(block, words)
            rows: list[list] = [[], [], [], [], [], [], []]
            for t in range(len(block.first) - 1):
                own = np.flatnonzero(text == t)
                length = min(how.window, len(own))
                if not length:
                    continue
                lo = own[0]
                at, window = _windows(hashes[own], text[own], length)
                found = [(p, h) for p, h in zip(at.tolist(), window.view(np.int64).tolist()) if (kind[lo + p : lo + p + length] == 0).sum() >= how.least_literals]
                each = [(0, p, len(found), length, h, _fillings(block.data, begin, end, kind, lo + p, length)) for p, h in found]
                if len(found) < len(at):
                    own = words[0] == t
                    length = min(how.window, int(own.sum()))
                    at, window = _windows(words[3][own], words[0][own], length, LITERAL)
                    each += [(1, p, len(at), length, h, []) for p, h in zip(at.tolist(), window.view(np.int64).tolist())]
                for row in each:
                    for column, value in zip(rows, (ids[block.begin + t], *row)):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()))
            yield [pa.array(c, t) for c, t in zip(rows, types)]

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), utf8(text_col, "text"))
    return map_rows(rows, "item_id long, literal int, item_pos long, item_windows long, length long, hash long, item_slots array<string>", cut)


def _bitmap(windows: DataFrame) -> np.ndarray:
    """A bit per hash, of fixed size however large the benchmark: at most ``2**(BITMAP_BITS - 6)`` rows reach the driver."""
    cells = windows.select(F.shiftrightunsigned("hash", 64 - BITMAP_BITS).alias("at")).selectExpr("shiftright(at, 6) AS cell", "shiftleft(1L, cast(at & 63 AS int)) AS bit")
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for r in cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).collect():
        out[r.cell] = r.bits
    return out.view(np.uint64)


def _document_hits(docs: DataFrame, how: Template, lengths: list[tuple[int, int]], bitmap: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, doc_pos, hash, doc_slots``: windows of documents whose bit is set; others cannot be in the benchmark."""

    def scan(batch):
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for block in wordhash.blocks(batch.column("text").to_pylist()):
            words = _words(block)
            template = tokens(block, words)
            for literal, length in lengths:
                text, hashes = (words[0], words[3]) if literal else (template[0], template[4])
                first = np.searchsorted(text, text)
                at, window = _windows(hashes, text, length, LITERAL if literal else 0)
                bit = window >> np.uint64(64 - BITMAP_BITS)
                hit = (bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
                if literal and length < how.least_literals:
                    hit &= np.bincount(text)[text[at]] == length
                at, window = at[hit], window[hit]
                slots = [[] if literal else _fillings(block.data, *template[1:4], p, length) for p in at.tolist()]
                yield [
                    pa.array(ids[block.begin + text[at]], pa.int64()),
                    pa.array(at - first[at], pa.int64()),
                    pa.array(window.view(np.int64), pa.int64()),
                    pa.array(slots, pa.list_(pa.string())),
                ]

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col, "text"))
    return map_rows(rows, "doc_id long, doc_pos long, hash long, doc_slots array<string>", scan)


def contaminated(docs: DataFrame, items: DataFrame, how: Template = Template(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, n_windows, item_windows, n_slots, n_changed`` per document and item that it contains.

    ``n_windows`` is the best alignment's count, of templates if those hold, else of words as they stand; ``n_changed`` says how many of the item's distinct slot
    values the document fills otherwise.  Null and empty texts, on either side, match nothing, nor does a
    row without an id.  Rows repeated under one id count once.  Empty tables give no rows.
    """
    windows = materialise(benchmark_windows(items, how), "benchmark")
    lengths = sorted((r.literal, r.length) for r in windows.select("literal", "length").distinct().collect())
    hits = materialise(_document_hits(docs, how, lengths, _bitmap(windows), id_col, text_col), "hits")
    met = hits.join(windows, "hash").select(
        "doc_id", "item_id", "literal", (F.col("doc_pos") - F.col("item_pos")).alias("shift"), "item_pos", "item_windows",
        F.when(F.size("item_slots") == F.size("doc_slots"), F.zip_with("item_slots", "doc_slots", lambda a, b: F.struct(a.alias("i"), b.alias("d")))).alias("pairs"),
    ).where("pairs is not null")
    # At one shift an item's place occurs once per document, so the lists are no longer than the item.
    lines = met.groupBy("doc_id", "item_id", "literal", "shift").agg(
        F.countDistinct("item_pos").alias("n"),
        F.countDistinct(F.when(F.forall("pairs", lambda p: p.i == p.d), F.col("item_pos"))).alias("n_same"),
        F.max("item_windows").alias("item_windows"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
    )
    values = F.size(F.array_distinct(F.transform("pairs", lambda p: p.i)))
    lines = lines.withColumn("n_windows", F.when(values == F.size("pairs"), F.col("n")).otherwise(F.col("n_same")))
    lines = lines.where(F.col("n_windows") >= F.least(F.lit(how.least_windows), F.col("item_windows")))
    changed = F.size(F.filter("pairs", lambda p: p.i != p.d))
    best = lines.groupBy("doc_id", "item_id").agg(
        F.max(F.struct((-F.col("literal")).alias("template"), "n_windows", (-changed).alias("same"), F.size("pairs").alias("n_slots"), "item_windows")).alias("best")
    )
    return best.select(
        "doc_id", "item_id", F.col("best.n_windows").cast("long").alias("n_windows"), F.col("best.item_windows").alias("item_windows"),
        F.col("best.n_slots").cast("long").alias("n_slots"), (-F.col("best.same")).cast("long").alias("n_changed"),
    )
