"""Sentiment of the documents, and the flagship composition."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.catalog import query, texts
from parley.catalog.mentions import _MATCH, TERMS
from parley.functions import wordlists as fixed
from parley.operators import matching, sentiment


def _list(words):
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


_LEXICON = ", ".join(f"('{t}', {v})" for t, v in fixed.VALENCE.items())
_ACTING = [w for w in fixed.NEGATIONS if w not in fixed.VALENCE]
_EDGE = sentiment.EDGE_PATTERN.replace("'", "''")


def _degree(p):
    up = [w for w in fixed.INTENSIFIERS if w not in fixed.VALENCE]
    down = [w for w in fixed.DAMPENERS if w not in fixed.VALENCE]
    return f"(CASE WHEN lower({p}) IN {_list(up)} THEN 0.293e0 WHEN lower({p}) IN {_list(down)} THEN -0.293e0 ELSE 0e0 END)"


def _shout(p):
    return f"(mixed AND upper({p}) = {p} AND lower({p}) <> {p})"


def _step(k, damp, idiom, factor):
    """One look-back level as a CTE: degree words first, then negation."""
    p, d = f"p{k}", _degree(f"p{k}")
    return f"""
lb{k}a AS (SELECT * EXCLUDE (v), CASE WHEN v = 0 OR {p} IS NULL THEN v ELSE v + {damp}e0 * ({d} * (CASE WHEN v < 0 THEN -1e0 ELSE 1e0 END)
    + CASE WHEN {d} <> 0 AND {_shout(p)} THEN (CASE WHEN v > 0 THEN 0.733e0 ELSE -0.733e0 END) ELSE 0e0 END) END AS v
  FROM {'scored' if k == 1 else f'lb{k - 1}'}),
lb{k} AS (SELECT * EXCLUDE (v), CASE WHEN v = 0 OR {p} IS NULL THEN v WHEN coalesce({idiom}, false) THEN v * {factor}e0
    WHEN lower({p}) IN {_list(_ACTING)} OR contains(lower({p}), 'n''t') THEN v * -0.74e0 ELSE v END AS v FROM lb{k}a)"""


SCORES_SQL = rf"""
WITH lexicon(token, valence) AS (VALUES {_LEXICON}),
texts AS (
  SELECT doc_id, text, source,
    list_transform(list_filter(regexp_split_to_array(text, '[\s\p{{Z}}]+'), lambda w: length(w) > 1),
                   lambda w: regexp_replace(w, '{_EDGE}', '\1\2')) AS t,
    least(len(text) - len(replace(text, '!', '')), 4) * 0.292e0 AS ep,
    len(text) - len(replace(text, '?', '')) AS qm
  FROM documents),
marked AS (
  SELECT *, ep + CASE WHEN qm <= 1 THEN 0e0 WHEN qm <= 3 THEN qm * 0.18e0 ELSE 0.96e0 END AS punctuation,
    len(list_filter(t, lambda w: upper(w) = w AND lower(w) <> w)) BETWEEN 1 AND len(t) - 1 AS mixed,
    coalesce(list_position(list_transform(t, lambda w: lower(w)), 'but'), 0) AS but_at
  FROM texts),
spoken AS (
  SELECT doc_id, source, punctuation, mixed, but_at, i AS spot, word, lead(word, 1) OVER seq AS after,
    lag(word, 1) OVER seq AS p1, lag(word, 2) OVER seq AS p2, lag(word, 3) OVER seq AS p3
  FROM (SELECT doc_id, source, punctuation, mixed, but_at, unnest(t) AS word, generate_subscripts(t, 1) AS i FROM marked)
  WINDOW seq AS (PARTITION BY doc_id ORDER BY i)),
scored AS (
  SELECT s.*, CASE WHEN l.valence IS NULL OR lower(word) IN {_list(fixed.INTENSIFIERS + fixed.DAMPENERS)}
      OR (lower(word) = 'kind' AND coalesce(lower(after) = 'of', false)) THEN 0e0
    WHEN {_shout('word')} THEN l.valence + sign(l.valence) * 0.733e0 ELSE CAST(l.valence AS DOUBLE) END AS v
  FROM spoken s LEFT JOIN lexicon l ON lower(s.word) = l.token),
{_step(1, 1.0, 'false', 1.0)},
{_step(2, 0.95, "lower(p2) = 'never' AND lower(p1) IN ('so', 'this')", 1.5)},
{_step(3, 0.9, "lower(p3) = 'never' AND (lower(p2) IN ('so', 'this') OR lower(p1) IN ('so', 'this'))", 1.25)},
final AS (
  SELECT doc_id, v * CASE WHEN lower(p1) = 'least' AND NOT coalesce(lower(p2) IN ('at', 'very'), false) THEN -0.74e0 ELSE 1e0 END
    * CASE WHEN but_at = 0 OR spot = but_at THEN 1e0 WHEN spot < but_at THEN 0.5e0 ELSE 1.5e0 END AS v
  FROM lb3),
sums AS (
  SELECT m.doc_id, m.source, any_value(m.punctuation) AS ep, coalesce(sum(v), 0e0) AS total,
    coalesce(sum(v + 1) FILTER (WHERE v > 0), 0e0) AS up, coalesce(sum(1 - v) FILTER (WHERE v < 0), 0e0) AS down,
    count(*) FILTER (WHERE v = 0) AS flat
  FROM marked m LEFT JOIN final f USING (doc_id) GROUP BY 1, 2),
adjusted AS (
  SELECT *, total + sign(total) * ep AS s, up + CASE WHEN up > down THEN ep ELSE 0e0 END AS u,
    down + CASE WHEN up < down THEN ep ELSE 0e0 END AS d FROM sums),
scores AS (
  SELECT doc_id, source, coalesce(round(d / nullif(u + d + flat, 0), 3), 0e0) AS neg,
    coalesce(round(flat / nullif(u + d + flat, 0), 3), 0e0) AS neu,
    coalesce(round(u / nullif(u + d + flat, 0), 3), 0e0) AS pos, round(s / sqrt(s * s + 15e0), 4) AS compound
  FROM adjusted),
labelled AS (
  SELECT *, CASE WHEN compound >= 0.05e0 THEN 'POSITIVE' WHEN compound <= -0.05e0 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS sentiment
  FROM scores)
"""


@query(SCORES_SQL + "SELECT doc_id, neg, neu, pos, compound, sentiment FROM labelled")
def sentiment_scores(spark, sf):
    return sentiment.sentiment_scores(texts(spark, sf), "doc_id", "text")


@query(SCORES_SQL + """
SELECT source, sentiment, count(*) AS n, round(avg(compound), 4) AS mean_compound FROM labelled GROUP BY 1, 2
""")
def sentiment_by_source(spark, sf):
    docs = texts(spark, sf)
    scores = sentiment.sentiment_scores(docs, "doc_id", "text")
    return (
        docs.select("doc_id", "source")
        .join(scores, "doc_id")
        .groupBy("source", "sentiment")
        .agg(F.count("*").alias("n"), F.round(F.avg("compound"), 4).alias("mean_compound"))
    )


@query(SCORES_SQL + rf"""
, kept AS (
  SELECT doc_id, {_MATCH} AS phrase,
    row_number() OVER (PARTITION BY trim(regexp_replace(lower(text), '\s+', ' ', 'g')) ORDER BY doc_id) AS rn
  FROM documents WHERE {_MATCH} <> '')
SELECT lower(phrase) AS matched_phrase, sentiment, count(*) AS n
FROM kept JOIN labelled USING (doc_id) WHERE rn = 1 GROUP BY 1, 2
""")
def mention_sentiment(spark, sf):
    """Flagship: documents that mention a term, first copies only, by phrase and sentiment."""
    from parley.operators import keys

    found = matching.mentions(texts(spark, sf), "text", TERMS)
    keyed = found.select(
        "doc_id", "text", "matched_phrase", F.sha2(keys.normalised_text(F.col("text")), 256).alias("copy_of")
    )
    once = keys.first_seen(keyed, ["copy_of"], ["doc_id"])
    scores = sentiment.sentiment_scores(once, "doc_id", "text").select("doc_id", "sentiment")
    return (
        once.select("doc_id", F.lower("matched_phrase").alias("matched_phrase"))
        .join(scores, "doc_id")
        .groupBy("matched_phrase", "sentiment")
        .agg(F.count("*").alias("n"))
    )
