"""Chunks, joined topic texts and topic summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.catalog import query, texts
from parley.catalog.terms import WEIGHTS_SQL, weights
from parley.operators import chunks, summarise, terms


@query("""
SELECT doc_id, CAST(k AS INT) AS chunk_no, md5(substring(text, k * 1024 + 1, 1024)) AS chunk_md5
FROM (SELECT doc_id, text, unnest(range(0, (length(text) + 1023) // 1024)) AS k FROM documents)
""")
def chunk_text(spark, sf):
    cut = chunks.chunk_text(texts(spark, sf), "doc_id", "text")
    return cut.select("doc_id", "chunk_no", F.md5("chunk").alias("chunk_md5"))


def _chunks_sql(source: str) -> str:
    """Chunks of the joined texts of ``source(topic, ord, text)``."""
    return f"""
  SELECT topic, k AS chunk_no, substring(joined, k * 1024 + 1, 1024) AS chunk
  FROM (SELECT topic, joined, unnest(range(0, (length(joined) + 1023) // 1024)) AS k
        FROM (SELECT topic, string_agg(text, ' ' ORDER BY ord) AS joined FROM {source} GROUP BY topic))"""


@query(f"""
WITH docs AS (SELECT source AS topic, doc_id AS ord, text FROM documents), chunks AS ({_chunks_sql('docs')})
SELECT topic, chunk_no, md5(chunk) AS chunk_md5 FROM chunks
""")
def group_concat_topic(spark, sf):
    cut = chunks.joined_chunks(texts(spark, sf), "source", "doc_id", "text")
    return cut.select("topic", "chunk_no", F.md5("chunk").alias("chunk_md5"))


def _summary_sql(level: int, chunks_from: str) -> str:
    """CTEs that summarise the chunks of one level into ``s{level}(topic, chunk_no, summary)``."""
    n = level
    return rf"""
c{n} AS MATERIALIZED ({chunks_from}),
sent{n} AS MATERIALIZED (
  SELECT topic, chunk_no, i, trim(s, E' \n\t\r\f\x0b') AS s, w FROM (
    SELECT topic, chunk_no, i, s, regexp_extract_all(lower(s), '[\p{{L}}\p{{N}}_]{{2,}}') AS w FROM (
      SELECT topic, chunk_no, unnest(parts) AS s, generate_subscripts(parts, 1) AS i FROM (
        SELECT topic, chunk_no, string_split(regexp_replace(regexp_replace(chunk, '([.!?])[ \t\r\f\v]+', '\1' || chr(1), 'g'),
                                             '\s*\n+\s*', chr(1), 'g'), chr(1)) AS parts FROM c{n})))
  WHERE len(w) > 0),
word{n} AS (SELECT topic, chunk_no, i, unnest(w) AS word FROM sent{n}),
freq{n} AS (SELECT topic, chunk_no, word, count(*) AS f, sum(count(*)) OVER (PARTITION BY topic, chunk_no) AS total
            FROM word{n} GROUP BY 1, 2, 3),
rank{n} AS MATERIALIZED (
  SELECT topic, chunk_no, i, row_number() OVER (PARTITION BY topic, chunk_no ORDER BY score DESC, i) AS r FROM (
    SELECT topic, chunk_no, i, round(sum(f) / (any_value(total) * count(*)), 9) AS score
    FROM word{n} JOIN freq{n} USING (topic, chunk_no, word) GROUP BY 1, 2, 3)),
gram{n} AS (
  SELECT topic, chunk_no, r, unnest(list_transform(range(1, len(w) - 1), lambda j: w[j] || ' ' || w[j + 1] || ' ' || w[j + 2])) AS g
  FROM sent{n} JOIN rank{n} USING (topic, chunk_no, i)),
dull{n} AS (
  SELECT DISTINCT topic, chunk_no, r
  FROM (SELECT *, min(r) OVER (PARTITION BY topic, chunk_no, g) AS best FROM gram{n}) WHERE best < r),
cand{n} AS (
  SELECT *, row_number() OVER (PARTITION BY topic, chunk_no ORDER BY r) AS nth
  FROM (SELECT topic, chunk_no, i, r, s, len(w) AS n, length(s) AS c FROM sent{n} JOIN rank{n} USING (topic, chunk_no, i))
  ANTI JOIN dull{n} USING (topic, chunk_no, r)),
pick{n} AS (
  SELECT topic, chunk_no, list_reduce(
    list_prepend({{'words': 0, 'used': 0, 'taken': []::BIGINT[], 'n': 0, 'c': 0, 'i': 0}},
                 list({{'words': 0, 'used': 0, 'taken': []::BIGINT[], 'n': n, 'c': c, 'i': i}} ORDER BY nth)),
    lambda a, b: CASE WHEN len(a.taken) = 0 OR (a.words < 40 AND a.words + b.n <= 150 AND a.used + 1 + b.c <= 512)
      THEN {{'words': a.words + b.n, 'used': a.used + b.c + CASE WHEN a.used > 0 THEN 1 ELSE 0 END,
             'taken': list_append(a.taken, b.i), 'n': 0, 'c': 0, 'i': 0}} ELSE a END).taken AS taken
  FROM cand{n} GROUP BY 1, 2),
made{n} AS (
  SELECT topic, chunk_no, string_agg(
    CASE WHEN c <= 512 THEN s
         ELSE coalesce(nullif(regexp_extract(left(s, 513), '(?s)^(.*[^ \t\r\n\f\v])[ \t\r\n\f\v]', 1), ''), left(s, 512)) END, ' ' ORDER BY i) AS summary
  FROM cand{n} JOIN pick{n} USING (topic, chunk_no) WHERE list_contains(taken, i) GROUP BY 1, 2),
s{n} AS MATERIALIZED (SELECT topic, chunk_no, coalesce(summary, '') AS summary FROM c{n} LEFT JOIN made{n} USING (topic, chunk_no)),
last{n} AS (SELECT topic, max(chunk_no) AS last FROM s{n} GROUP BY 1),
next{n} AS (SELECT topic, chunk_no AS ord, summary AS text FROM s{n} JOIN last{n} USING (topic) WHERE {n} = 0 OR last > 0)"""


# More levels than any topic needs: each one leaves at most half of the text.
_LEVELS = 10

SUMMARIES_SQL = (
    "docs AS (SELECT source AS topic, doc_id AS ord, text FROM documents),"
    + ",".join(_summary_sql(n, _chunks_sql("docs" if n == 0 else f"next{n - 1}")) for n in range(_LEVELS))
    + ", summaries AS ("
    + " UNION ALL ".join(
        f"SELECT topic, summary FROM s{n} JOIN last{n} USING (topic) WHERE last = 0" for n in range(1, _LEVELS)
    )
    + ")"
)


@query(
    "WITH docs AS (SELECT source AS topic, doc_id AS ord, text FROM documents),"
    + _summary_sql(0, _chunks_sql("docs"))
    + " SELECT topic, chunk_no, summary FROM s0"
)
def summarise_chunks(spark, sf):
    cut = chunks.joined_chunks(texts(spark, sf), "source", "doc_id", "text")
    return summarise.summarise_chunks(cut).select("topic", "chunk_no", "summary")


@query(WEIGHTS_SQL + "," + SUMMARIES_SQL + """
SELECT '2024-01-30' AS date, topic, summary, keywords, size FROM summaries
JOIN (SELECT topic, string_agg(term, ', ' ORDER BY rank) AS keywords FROM top GROUP BY topic) USING (topic)
JOIN (SELECT source AS topic, count(*) AS size FROM documents GROUP BY 1) USING (topic)
""")
def topic_summaries(spark, sf):
    docs = texts(spark, sf).withColumn("topic", F.col("source"))
    top = terms.top_terms(weights(spark, sf))
    keywords = top.groupBy("topic").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda s: s["term"]).alias("keybert"))
    summaries = summarise.topic_summaries(docs, "doc_id", "text", keywords.withColumn("mmr", F.col("keybert")), "2024-01-30")
    return summaries.select(F.col("date").cast("string").alias("date"), "topic", "summary", F.col("keybert").alias("keywords"), "size")
