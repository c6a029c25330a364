"""Topic summaries: chunks are summarised, the summaries joined and summarised again."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.operators.chunks import CHUNK_WIDTH, joined_chunks
from parley.runtime import materialise

# Target length of a summary in words.
MIN_WORDS, MAX_WORDS = 40, 150
NO_REPEAT = 3

_SENTENCE = re.compile(r"(?<=[.!?])[ \t\r\f\v]+|\s*\n+\s*")
_WORD = re.compile(r"\w{2,}")
_WORDS_THAT_FIT = re.compile(r"(.*[^ \t\r\n\f\v])[ \t\r\n\f\v]", re.S)


def _fitted(sentence: str, room: int) -> str:
    """A sentence that is too long for any summary ends at the last white space that fits; one long word is cut."""
    if len(sentence) <= room:
        return sentence
    whole = _WORDS_THAT_FIT.match(sentence[: room + 1])
    return whole.group(1) if whole else sentence[:room]


def extract_sentences(text: str, min_words: int = MIN_WORDS, max_words: int = MAX_WORDS, room: int = CHUNK_WIDTH // 2) -> str:
    """The sentences with the most frequent words, in text order (Nenkova & Vanderwende 2005).

    A sentence that repeats three words in a row of a better one is left out.  Sentences are taken
    until ``min_words`` are reached; one that would pass ``max_words``, or ``room`` characters in all, is skipped.
    The first is always taken, up to the last word that fits.  Summaries are whole sentences, then, and at most half a
    chunk long, so joining them always shrinks the text.
    """
    split = [(s, _WORD.findall(s.lower())) for s in _SENTENCE.split(text)]
    split = [(s.strip(), w) for s, w in split if w]
    count = Counter(word for _, words in split for word in words)
    total = sum(count.values())
    score = [round(sum(count[w] for w in words) / (total * len(words)), 9) for _, words in split]
    seen, taken, length, used = set(), [], 0, 0
    for i in sorted(range(len(split)), key=lambda i: (-score[i], i)):
        sentence, words = split[i]
        grams = {tuple(words[j : j + NO_REPEAT]) for j in range(len(words) - NO_REPEAT + 1)}
        fresh = not (grams & seen)
        seen |= grams
        fits = length < min_words and length + len(words) <= max_words and used + 1 + len(sentence) <= room
        if fresh and (not taken or fits):
            taken.append(i)
            length += len(words)
            used += len(sentence) + (used > 0)
    return " ".join(_fitted(split[i][0], room) for i in sorted(taken))


Summariser = Callable[[Column], Column]


def extractive(min_words: int = MIN_WORDS, max_words: int = MAX_WORDS, room: int = CHUNK_WIDTH // 2) -> Summariser:
    """The default summariser as a column function.  A model goes in its place as
    ``predict_batch_udf(load_model, return_type=StringType(), batch_size=...)``, loaded once a worker."""

    @F.pandas_udf(T.StringType())
    def best_sentences(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: extract_sentences(t, min_words, max_words, room))

    return best_sentences


def summarise_chunks(chunks: DataFrame, summariser: Summariser | None = None) -> DataFrame:
    """Add ``summary`` to every chunk row; map-only."""
    return chunks.withColumn("summary", (summariser or extractive())(F.col("chunk")))


def summarise_topics(
    docs: DataFrame,
    topic: str,
    order: str,
    text: str,
    width: int = CHUNK_WIDTH,
    summariser: Summariser | None = None,
    max_levels: int = 64,
) -> DataFrame:
    """``(topic, summary)``: chunk, summarise, join the summaries, and so on down to one chunk.

    The first level reads the corpus; every level after it at most half as much.  A topic leaves
    when its joined summaries fit into one chunk, whose summary is the result.
    """
    chunks = joined_chunks(docs, topic, order, text, width)
    finished = []
    for level in range(max_levels):
        summaries = materialise(summarise_chunks(chunks, summariser).select("topic", "chunk_no", "summary"), "summaries")
        if level:
            # from the second level on, a topic of one chunk is done
            last = summaries.groupBy("topic").agg(F.max("chunk_no").alias("last"))
            single = last.where("last = 0").select("topic")
            finished.append(summaries.join(single, "topic", "left_semi").select("topic", "summary"))
            summaries = summaries.join(single, "topic", "left_anti")
            if summaries.isEmpty():
                break
        chunks = joined_chunks(summaries, "topic", "chunk_no", "summary", width)
    else:
        raise ValueError("the summariser does not shorten its input")
    result = finished[0]
    for part in finished[1:]:
        result = result.unionByName(part)
    return result


def topic_summaries(
    assigned: DataFrame, order: str, text: str, keywords: DataFrame, run_date, summariser: Summariser | None = None
) -> DataFrame:
    """``(date, topic, summary, keybert, mmr, size)`` for every topic but the outliers.

    ``assigned`` has a ``topic`` column; ``keywords`` is ``(topic, keybert, mmr)`` with arrays.
    """
    kept = assigned.where(F.col("topic").cast("string") != "-1")
    sizes = kept.groupBy("topic").agg(F.count("*").alias("size"))
    return (
        summarise_topics(kept, "topic", order, text, summariser=summariser)
        .join(sizes, "topic")
        .join(keywords, "topic", "left")
        .select(
            F.lit(run_date).cast("date").alias("date"),
            "topic",
            "summary",
            F.array_join("keybert", ", ").alias("keybert"),
            F.array_join("mmr", ", ").alias("mmr"),
            "size",
        )
    )
