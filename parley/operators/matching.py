"""Dictionary match on free text, and extraction of the comments that mention a term."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions import automaton
from parley.functions.patterns import alternation, leftmost_match
from parley.operators.keys import first_rows, first_seen
from parley.operators.recency import moment
from parley.runtime import materialise

# The columns of an extracted comment, in order.
EXTRACTED = ("subreddit", "post_title", "comment_id", "comment_date", "comment", "matched_phrase", "upvotes")

# Up to this many terms go into one regular expression, up to this many characters of terms into one automaton that
# is sent to the tasks; beyond, terms and texts meet by a word.  All three find the same matches.
ALTERNATION_LIMIT = 2_000
AUTOMATON_CHARS = 1 << 25

Terms = Sequence[str] | DataFrame


def term_list(terms: DataFrame, limit: int = ALTERNATION_LIMIT) -> list[str] | None:
    """The terms as a Python list, or None when there are more than ``limit``."""
    rows = terms.select("term").limit(limit + 1).collect()
    return [r[0] for r in rows] if len(rows) <= limit else None


def mentions(df: DataFrame, text: str, terms: Terms, out: str = "matched_phrase", **options) -> DataFrame:
    """Rows that mention a term, with the leftmost match, of equal starts the longest, as it stands in the text.

    ``terms`` are strings or a table with a column ``term``, of any length.  A map-only pass, but for dictionaries that do not
    fit one automaton.  ``options`` go to ``alternation`` and hold for regular expressions only.
    """
    if isinstance(terms, DataFrame):
        listed = terms.select("term").where(F.length("term") > 0).distinct()
        if (listed.agg(F.sum(F.length("term"))).first()[0] or 0) > AUTOMATON_CHARS:
            return mentions_by_join(df, text, listed, out)
        terms = [r[0] for r in listed.collect()]
    if options or len(terms) <= ALTERNATION_LIMIT:
        found = leftmost_match(F.col(text), alternation(terms, **options)) if any(terms) else F.lit(None).cast("string")
        return df.withColumn(out, found).where(F.col(out).isNotNull())
    return mentions_by_automaton(df, text, terms, out)


def mentions_by_automaton(df: DataFrame, text: str, terms: Iterable[str], out: str = "matched_phrase") -> DataFrame:
    """``mentions`` with one automaton of all terms, built once and sent to every executor once."""
    held = df.sparkSession.sparkContext.broadcast(automaton.Terms(terms))

    @F.pandas_udf("string")
    def first(texts: pd.Series) -> pd.Series:
        return texts.map(held.value.first)

    return df.withColumn(out, first(text)).where(F.col(out).isNotNull())


def mentions_by_join(df: DataFrame, text: str, terms: DataFrame, out: str = "matched_phrase") -> DataFrame:
    """``mentions`` for a dictionary of any size: texts and terms meet by each term's longest word.

    Only the distinct words of a text are joined, and each text looks for the terms that it could hold.  Terms without
    any word are held in an automaton.  ``df`` is written once, with a number for every row.
    """
    rows = materialise(df.withColumn("row_number", F.monotonically_increasing_id()), "rows")

    def anchored(batches):
        for batch in batches:
            found = [(t, *(automaton.anchor(automaton.fold(t)) or ("", 0))) for t in batch.column("term").to_pylist()]
            yield pa.RecordBatch.from_pydict({"term": [f[0] for f in found], "word": [f[1] for f in found]})

    def words(batches):
        for batch in batches:
            at, held = [], []
            for i, content in zip(batch.column("row_number").to_pylist(), batch.column("content").to_pylist()):
                each = {w for w, _ in automaton.word_runs(automaton.fold(content))}
                at += [i] * len(each)
                held += each
            yield pa.RecordBatch.from_pydict({"row_number": pa.array(at, pa.int64()), "word": pa.array(held, pa.string())})

    by_word = materialise(terms.select("term").where(F.length("term") > 0).distinct().mapInArrow(anchored, "term string, word string"), "anchors")
    # Every term with one word of the text, which is few of its words.
    content = rows.where(F.col(text).isNotNull()).select("row_number", F.col(text).cast("string").alias("content"))
    met = content.mapInArrow(words, "row_number long, word string").join(by_word.where("word <> ''"), "word")
    near = met.groupBy("row_number").agg(F.collect_list("term").alias("near"))
    loose = [r[0] for r in by_word.where("word = ''").select("term").collect()]
    held = df.sparkSession.sparkContext.broadcast(loose)

    @F.pandas_udf("string")
    def first(texts: pd.Series, near: pd.Series) -> pd.Series:
        return pd.Series([automaton.Terms([*held.value, *(() if n is None else n)]).first(t) for t, n in zip(texts, near)], dtype=object)

    joined = rows.join(near, "row_number", "left")
    if not loose:
        joined = joined.where(F.col("near").isNotNull())
    return joined.withColumn(out, first(text, "near")).where(F.col(out).isNotNull()).drop("row_number", "near")


def map_to_owners(matched: DataFrame, owners: DataFrame, phrase: str = "matched_phrase") -> DataFrame:
    """Add ``owner`` for every entry the phrase may stand for (one row each)."""
    return matched.withColumn("term", F.lower(F.trim(phrase))).join(owners, "term", "left").drop("term")


def flatten_posts(posts: DataFrame, run_ts: dt.datetime, max_age: dt.timedelta = dt.timedelta(days=1)) -> DataFrame:
    """One row per comment of the posts not older than ``max_age``; old posts go before the unnest."""
    young = posts.where(F.timestamp_seconds("created_utc") >= moment(run_ts - max_age))
    return young.select(
        "subreddit",
        F.col("post_id"),
        F.col("title").alias("post_title"),
        F.col("created_utc").alias("post_created"),
        F.posexplode("comments").alias("position", "c"),
    ).select(
        "subreddit", "post_id", "post_title", "post_created", "position",
        F.col("c.id").alias("comment_id"),
        F.timestamp_seconds("c.created_utc").alias("comment_date"),
        F.col("c.body").alias("comment"),
        F.col("c.score").alias("upvotes"),
    )


def fresh_comments(posts: DataFrame, last_run: dt.datetime, run_ts: dt.datetime) -> DataFrame:
    """Comments of young posts, newer than ``last_run``."""
    return flatten_posts(posts, run_ts).where(F.col("comment_date") > moment(last_run))


def matching_comments(posts: DataFrame, terms: Terms, last_run: dt.datetime, run_ts: dt.datetime) -> DataFrame:
    """Comments of young posts, newer than ``last_run``, that mention a term."""
    return mentions(fresh_comments(posts, last_run, run_ts), "comment", terms)


def extract_comments(
    posts: DataFrame,
    terms: Terms,
    last_run: dt.datetime,
    run_ts: dt.datetime,
    target: int | None = None,
) -> DataFrame:
    """The matching comments once each, newest posts first.

    ``target`` is the exact number of matches to keep, over all subreddits in order.
    """
    order = ["subreddit", F.desc("post_created"), "post_id", "position"]
    once = first_seen(matching_comments(posts, terms, last_run, run_ts), ["comment_id"], order)
    kept = first_rows(once, order, target) if target is not None else once
    return kept.select(*EXTRACTED)
