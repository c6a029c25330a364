"""Language ID by compression: the language whose raw-content dictionary makes a text smallest.

A dictionary is a bounded sample of labelled texts of one language.  Every text is cut into pieces of
``piece_bytes``, all of which are compressed with each language's dictionary; short pieces keep the
dictionary, not the text's own repetition, in charge.  The language with the smallest sum wins; the
margin to the next one gives the score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UNDETERMINED = "und"
# A document whose two best languages are closer than this is rejected.
LEAST_MARGIN = 0.002
LETTER = regex.compile(r"\p{L}")
NO_WORD = re.compile(r"[\W\d_]+")
# The encoder looks for no match in the last bytes of its input; the same filler after each piece keeps them free of text.
FILLER = b" " + b"0" * 15


@dataclass(frozen=True)
class Dictionaries:
    """``sample_texts`` and ``sample_chars`` bound what a language's dictionary is fitted on."""

    sample_texts: int = 400
    sample_chars: int = 1000
    dictionary_bytes: int = 1 << 17
    piece_bytes: int = 1 << 12
    level: int = 3


def plain(text: str) -> bytes:
    """A text's words in lower case with one space between; symbols and digits carry no language."""
    return NO_WORD.sub(" ", text.lower()).encode()


def held_out(id_col: str) -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, how: Dictionaries = Dictionaries(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Dictionary content per language, from at most ``sample_texts`` labelled rows of it that are not held out.

    The rows are those with the smallest hashes of text and id.  Rows per language and bit length of the hash
    are counted first, at most 63 counts a language; lengths beyond those that hold ``sample_texts`` rows
    are left out, so about twice that many rows of a language are ordered, whatever its size.
    """
    text = F.col(text_col)
    rows = docs.where(text.isNotNull() & F.col(lang_col).isNotNull() & ~held_out(id_col) & (F.length(F.trim(text)) > 0))
    rows = rows.select(
        F.col(lang_col).alias("lang"),
        F.substring(text, 1, how.sample_chars).alias("text"),
        F.shiftrightunsigned(F.xxhash64(text, F.col(id_col)), 1).alias("at"),
    ).withColumn("bits", F.length(F.bin("at")))
    reached: dict[str, int] = {}
    longest: dict[str, int] = {}
    for r in sorted(rows.groupBy("lang", "bits").count().collect(), key=lambda r: r.bits):
        if reached.get(r.lang, 0) < how.sample_texts:
            reached[r.lang] = reached.get(r.lang, 0) + r["count"]
            longest[r.lang] = r.bits
    if not longest:
        return {}
    limits = docs.sparkSession.createDataFrame(sorted(longest.items()), "lang string, longest int")
    rows = rows.join(F.broadcast(limits), "lang").where("bits <= longest")
    order = Window.partitionBy("lang").orderBy("at", "text")
    rows = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= how.sample_texts)
    content: dict[str, bytes] = {}
    for r in rows.orderBy("lang", "n").collect():
        content[r.lang] = content.get(r.lang, b"") + plain(r.text) + b" "
    return {lang: data[-how.dictionary_bytes :] for lang, data in content.items()}


def predict(rows: DataFrame, content: dict[str, bytes], how: Dictionaries = Dictionaries(), text_col: str = "text") -> DataFrame:
    """``rows`` with ``lang_pred, score, margin`` at the end, from the text alone.

    ``margin`` is the share of bytes that the best dictionary saves against the second best; ``score`` is
    ``m / (m + 0.02)`` of it.  A null text or one without a letter is ``und`` with score 0; ties of size go to
    the first language by name.  Without any learned language everything is ``und``.
    """
    languages = sorted(content)
    size, names = how.piece_bytes, [*rows.columns, "lang_pred", "score", "margin"]

    def judge(batches):
        coders = []
        for lang in languages:
            words = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=how.level)
            coders.append(zstandard.ZstdCompressor(dict_data=words, write_content_size=False).compress)
        for batch in batches:
            found: list[list] = [[], [], []]
            for text in batch.column(text_col).to_pylist():
                verdict = (UNDETERMINED, 0.0, 0.0)
                if text is not None and coders and LETTER.search(text):
                    data = plain(text)
                    pieces = [b" " + data[i : i + size] + FILLER for i in range(0, len(data), size)]
                    sums = [sum(len(code(p)) for p in pieces) for code in coders]
                    order = np.argsort(sums, kind="stable")
                    margin = 1.0 if len(sums) == 1 else 1 - sums[order[0]] / sums[order[1]]
                    verdict = (languages[order[0]], margin / (margin + 0.02), margin)
                for column, value in zip(found, verdict):
                    column.append(value)
            types = (pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, t) for c, t in zip(found, types))], names=names)

    fields = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields), "lang_pred string", "score double", "margin double"]
    return rows.mapInArrow(judge, ", ".join(fields))


def rejected(least_margin: float) -> Column:
    return (F.col("lang_pred") == UNDETERMINED) | (F.col("margin") <= least_margin)


def identify(docs: DataFrame, how: Dictionaries = Dictionaries(), least_margin: float = LEAST_MARGIN, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, margin, rejected``: fitted on the labelled part, predicted for all.

    ``rejected`` marks ``und`` and margins not above ``least_margin``.  A row without an id is learned from and
    predicted like any other; rows repeated under one id are predicted each.  Other columns are not read.
    """
    content = fit(docs, how, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return predict(rows, content, how).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "margin", rejected(least_margin).alias("rejected")
    )


def identified(docs: DataFrame, how: Dictionaries = Dictionaries(), least_margin: float = LEAST_MARGIN, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns, whatever these are called."""
    hidden = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    place = {name: f"c{i}" for i, name in reversed(list(enumerate(docs.columns)))}
    content = fit(hidden, how, place[id_col], place[text_col], place[lang_col])
    judged = predict(hidden, content, how, place[text_col]).where(~rejected(least_margin))
    return judged.drop("lang_pred", "score", "margin").toDF(*docs.columns)
