"""The two recurring jobs: extract-store-score, and the daily topics with their summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.operators import matching, sentiment
from parley.operators.keys import dense_order, first_rows
from parley.operators.summarise import Summariser, topic_summaries
from parley.plans.topic_model import fit_topics
from parley.runtime import materialise
from parley.schemas import TOPIC_SUMMARIES, clean_comments
from parley.sources.store import Store, due_today

EXTRACT = "extract"


def store_and_score(store: Store, found: DataFrame, lexicon: DataFrame | None = None) -> None:
    """Append new comments and their sentiment, under the same day; both appends are safe to repeat."""
    comments = clean_comments(found).withColumn("key", F.struct("comment_id", F.to_date("comment_date").alias("day")))
    store.insert_new_comments(comments.drop("key"))
    scores = sentiment.sentiment_scores(comments, "key", "comment", lexicon)
    store.update_sentiment(scores.select("key.*", "compound", "sentiment"))


def run_extract(
    store: Store,
    posts: DataFrame,
    terms: matching.Terms,
    run_ts: dt.datetime,
    target: int | None = None,
    lexicon: DataFrame | None = None,
) -> None:
    """One run over what has landed since the last one.

    With ``target`` the run stops at the time by which that many matches have come, oldest first; matches
    of that very time are all kept.  The mark moves to the newest comment stored, and only after both
    appends succeeded, so nothing written while the job ran, or left by a target, is skipped by the next.
    """
    store.create_tables()
    since = store.last_run(EXTRACT, run_ts)
    found = materialise(matching.extract_comments(posts, terms, since, run_ts), "extracted")
    if target is not None:
        last = first_rows(found.select("comment_date"), ["comment_date"], target).agg(F.max("comment_date").alias("last"))
        found = materialise(found.join(F.broadcast(last), F.col("comment_date") <= F.col("last")).drop("last"), "extracted")
    store_and_score(store, found, lexicon)
    newest = found.agg(F.date_format(F.max("comment_date"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    if newest:
        store.record_run(EXTRACT, dt.datetime.fromisoformat(newest))


def run_daily_topics(
    store: Store, run_ts: dt.datetime, n_days: int = 7, summariser: Summariser | None = None, **model_options
) -> bool:
    """Topics and summaries of the last ``n_days`` comments; False when the day has them already."""
    store.create_tables()
    if not due_today(store.read("topic_summaries", TOPIC_SUMMARIES), run_ts.date()):
        return False
    recent = store.recent_comments(run_ts, n_days).select("comment_id", "comment_date", "comment")
    recent = materialise(dense_order(recent, ["comment_date", "comment_id"]), "recent")
    if recent.isEmpty():
        return False
    model = fit_topics(recent, "ord", "comment", run_date=run_ts.date(), **model_options)
    assigned = recent.join(model.assigned, "ord")
    keywords = model.info.select("topic", "keybert", "mmr")
    store.update_topic_summaries(
        topic_summaries(assigned, "ord", "comment", keywords, run_ts.date(), summariser=summariser)
    )
    return True
