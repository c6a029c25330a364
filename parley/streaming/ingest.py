"""The extract job as a stream: landing folder in, comments and sentiment tables out.

Every micro-batch is loaded with anti-joined appends, so replaying one after a failure adds nothing,
and a copy is recognised however late it comes.  No row is dropped for its age: there is no watermark.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.operators import matching
from parley.operators.recency import moment
from parley.plans.pipeline import run_daily_topics, store_and_score
from parley.runtime import materialise
from parley.sources.store import Store

def run_available(stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process everything that has landed, then stop; the checkpoint remembers what was done."""
    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def loader(store: Store, terms: matching.Terms, lexicon: DataFrame | None = None) -> Callable[[DataFrame, int], None]:
    """Finds the mentions of one batch, written once, and adds them to both tables."""

    def load(batch: DataFrame, _: int) -> None:
        found = materialise(matching.mentions(batch, "comment", terms).select(*matching.EXTRACTED), "batch")
        if not found.isEmpty():
            store_and_score(store, found, lexicon)

    return load


def ingest_comments(
    comments: DataFrame, terms: matching.Terms, store: Store, last_run: dt.datetime, checkpoint: str, lexicon: DataFrame | None = None
) -> None:
    """A stream of single comments: newer than the mark, mentioning a term, each once."""
    fresh = comments.where(F.col("comment_date") > moment(last_run))
    store.create_tables()
    run_available(fresh, loader(store, terms, lexicon), checkpoint)


def ingest_posts(
    posts: DataFrame, terms: matching.Terms, store: Store, last_run: dt.datetime, run_ts: dt.datetime, checkpoint: str,
    lexicon: DataFrame | None = None,
) -> None:
    """A stream of posts with their comments; posts older than a day are dropped before the unnest."""
    fresh = matching.fresh_comments(posts, last_run, run_ts)
    store.create_tables()
    run_available(fresh, loader(store, terms, lexicon), checkpoint)


def ingest_daily_topics(store: Store, run_ts: dt.datetime, **options) -> bool:
    """The daily job behind its once-a-day gate, to be called after an ingest run."""
    return run_daily_topics(store, run_ts, **options)
