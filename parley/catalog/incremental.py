"""Incremental reads, look-backs, duplicates, appends, limits, threads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from parley import schemas
from parley.catalog import query, table, texts
from parley.operators import keys, recency, threads

# The run clock of the queries.
LAST_RUN = dt.datetime(2024, 1, 20, 9, 32, 48)
RUN_TS = dt.datetime(2024, 1, 30, 12, 0, 0)
_STAMP = "strftime(ts, '%Y-%m-%d %H:%M:%S')"


def _stamp(column="ts"):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


@query(f"SELECT event_id, user_id, {_STAMP} AS at FROM events WHERE ts > TIMESTAMP '{LAST_RUN}'")
def incremental_new_events(spark, sf):
    fresh = recency.newer_than(table(spark, sf, "events"), "ts", LAST_RUN)
    return fresh.select("event_id", "user_id", _stamp().alias("at"))


@query(f"""
SELECT e.event_id, e.user_id FROM events e
JOIN (SELECT user_id FROM events GROUP BY user_id HAVING min(ts) >= TIMESTAMP '2024-01-01 06:00:00') p USING (user_id)
""")
def recent_parents_only(spark, sf):
    events = table(spark, sf, "events")
    parents = events.groupBy("user_id").agg(F.min("ts").alias("created"))
    young = recency.not_older(parents, "created", dt.datetime(2024, 1, 2, 6), dt.timedelta(days=1))
    return events.join(young, "user_id", "left_semi").select("event_id", "user_id")


@query(f"""
SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events
WHERE ts >= TIMESTAMP '{RUN_TS}' - INTERVAL 7 DAY GROUP BY event_type
""")
def recent_lookback(spark, sf):
    recent = recency.not_older(table(spark, sf, "events"), "ts", RUN_TS, dt.timedelta(days=7))
    return recent.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("""
WITH daily AS (SELECT CAST(ts AS DATE) AS d, event_type, count(*) AS n, sum(value) AS v FROM events GROUP BY 1, 2)
SELECT strftime(d + CAST(k AS INT), '%Y-%m-%d') AS run_date, event_type,
       CAST(sum(n) AS BIGINT) AS n, round(sum(v), 2) AS total
FROM daily, range(7) r(k) GROUP BY 1, 2
""")
def rolling_7d_daily(spark, sf):
    rolled = recency.rolling_days(
        table(spark, sf, "events"), "ts", ["event_type"], 7, n=("count", "event_id"), total=("sum", "value")
    )
    return rolled.select(
        F.date_format("run_date", "yyyy-MM-dd").alias("run_date"), "event_type", "n", F.round("total", 2).alias("total")
    )


@query(r"""
SELECT doc_id, lang, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY trim(regexp_replace(lower(text), '\s+', ' ', 'g')) ORDER BY doc_id) AS rn
  FROM documents) WHERE rn = 1
""")
def dedup_first_seen(spark, sf):
    docs = texts(spark, sf)
    keyed = docs.select(
        "doc_id", "lang", "source", "n_chars", F.sha2(keys.normalised_text(F.col("text")), 256).alias("key")
    )
    return keys.first_seen(keyed, ["key"], ["doc_id"]).drop("key")


@query("""
SELECT d.doc_id, d.source, md5(d.text) AS text_md5 FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def append_only_new(spark, sf):
    fresh = keys.not_stored(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")
    return fresh.select("doc_id", "source", F.md5("text").alias("text_md5"))


@query("""
SELECT conv_id, turn, role, length(text) AS n_chars FROM conversations ORDER BY conv_id DESC, turn LIMIT 100
""")
def target_limit_ordered(spark, sf):
    kept = keys.first_rows(table(spark, sf, "conversations"), [F.desc("conv_id"), "turn"], 100)
    return kept.select("conv_id", "turn", "role", F.length("text").alias("n_chars"))


@query("""
WITH RECURSIVE walk AS (
  SELECT c.conv_id, c.turn, c.turn AS root, 0 AS depth FROM conversations c
  WHERE NOT EXISTS (SELECT 1 FROM conversations p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 1)
  UNION ALL
  SELECT c.conv_id, c.turn, w.root, w.depth + 1 FROM walk w JOIN conversations c
    ON c.conv_id = w.conv_id AND c.turn = w.turn + 1
)
SELECT conv_id || ':' || turn AS id, conv_id || ':' || root AS root, depth FROM walk
""")
def thread_flatten(spark, sf):
    at = lambda turn: F.concat_ws(":", "conv_id", turn)
    replies = table(spark, sf, "conversations").select(
        at(F.col("turn")).alias("id"),
        F.when(F.col("turn") > 0, at(F.col("turn") - 1)).alias("parent_id"),
    )
    return threads.flatten_threads(replies)


@query("SELECT strftime(max(CAST(ts AS DATE)), '%Y-%m-%d') AS latest FROM events")
def latest_date(spark, sf):
    return table(spark, sf, "events").agg(F.date_format(F.max(F.to_date("ts")), "yyyy-MM-dd").alias("latest"))


@query("""
SELECT CAST(event_id AS VARCHAR) AS comment_id, '' AS post_title, '' AS subreddit,
       event_type AS comment, '' AS matched_phrase, CAST(0 AS BIGINT) AS upvotes, '2024-01-30' AS date
FROM events
""")
def conform_schema(spark, sf):
    partial = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("comment_id"), F.col("event_type").alias("comment")
    )
    repaired = schemas.conform(partial, schemas.COMMENTS).drop("comment_date")
    return repaired.withColumn("date", F.lit(str(RUN_TS.date())))


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso,
       strftime(ts, '%Y-%m-%d') AS day, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch_s,
       strftime(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') - INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS week_before
FROM events
""")
def format_timestamps(spark, sf):
    stamp = recency.stamp(F.col("ts"))
    parsed = recency.parse_stamp(stamp)
    return table(spark, sf, "events").select(
        "event_id",
        stamp.alias("stamp"),
        recency.iso(F.col("ts")).alias("iso"),
        F.date_format(F.to_date("ts"), "yyyy-MM-dd").alias("day"),
        recency.epoch_of(parsed).alias("epoch_s"),
        recency.stamp(recency.days_before(parsed, 7)).alias("week_before"),
    )


@query(r"""
SELECT count(*) AS rows_checked,
       count(*) FILTER (WHERE regexp_matches(text, '(?i)(?:^|[^\p{L}\p{N}_])trash(?:$|[^\p{L}\p{N}_])')) AS rows_collected,
       CAST(sum(length(text)) AS BIGINT) AS chars
FROM documents
""")
def run_counters(spark, sf):
    return recency.counters(texts(spark, sf), "text", ["trash"])
