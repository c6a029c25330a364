"""Dictionary match, dictionary patterns and template expansion."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.catalog import query, table, texts
from parley.operators import generate, matching
from parley.sources import dictionary

# The terms looked for in the documents (single words and a two-word term).
TERMS = ["worthless", "trash", "idiot", "es", "of the", "the"]
# Sentence templates of the expansion query.
TEMPLATES = ["Love the new {} app", "{} raised its fees", "Is {} down again?"]

_TERM_RE = "|".join(sorted(TERMS, key=lambda t: (-len(t), t)))
_MATCH = (
    rf"regexp_extract(text, '(?i)(?:^|[^\p{{L}}\p{{N}}_])({_TERM_RE})(?:$|[^\p{{L}}\p{{N}}_])', 1)"
)


@query(f"""
SELECT doc_id, source, {_MATCH} AS matched_phrase FROM documents WHERE {_MATCH} <> ''
""")
def mention_extract(spark, sf):
    docs = texts(spark, sf)
    return matching.mentions(docs, "text", TERMS).select("doc_id", "source", "matched_phrase")


@query(f"""
SELECT source, lower({_MATCH}) AS phrase, count(*) AS n
FROM documents WHERE {_MATCH} <> '' GROUP BY 1, 2
""")
def mention_counts_by_source(spark, sf):
    found = matching.mentions(texts(spark, sf), "text", TERMS)
    return found.groupBy("source", F.lower("matched_phrase").alias("phrase")).agg(F.count("*").alias("n"))


_BORDER = r"[^\p{L}\p{N}_]"


@query(rf"""
WITH term AS (
  SELECT DISTINCT lower(p_name) AS term FROM part UNION SELECT 'worthless' UNION SELECT 'of the' UNION SELECT 'the'
), low AS (
  SELECT doc_id, text, lower(text) AS t FROM documents
), held AS (
  SELECT doc_id, text, term,
         regexp_extract(t, '(?s)^(.*?(?:^|{_BORDER}))' || regexp_escape(term) || '(?:$|{_BORDER})', 1) AS before
  FROM low JOIN term ON contains(t, term)
  WHERE regexp_matches(t, '(?:^|{_BORDER})' || regexp_escape(term) || '(?:$|{_BORDER})')
)
SELECT doc_id, arg_min(substr(text, length(before) + 1, length(term)), length(before) * 1000 - length(term)) AS matched_phrase
FROM held GROUP BY doc_id
""")
def mention_extract_by_join(spark, sf):
    extra = spark.createDataFrame([("worthless",), ("of the",), ("the",)], "term string")
    terms = table(spark, sf, "part").select(F.lower("p_name").alias("term")).distinct().union(extra)
    docs = texts(spark, sf).select("doc_id", "text")
    return matching.mentions_by_join(docs, "text", terms).select("doc_id", "matched_phrase")


@query(rf"""
WITH own AS (
  SELECT DISTINCT 'the ' || p_name AS term FROM part
  UNION SELECT DISTINCT p_name FROM part UNION SELECT 'idiot' UNION SELECT 'es' UNION SELECT 'of the,'
), low AS (
  SELECT doc_id, text, lower(text) AS t FROM documents
), held AS (
  SELECT doc_id, text, term,
         regexp_extract(t, '(?s)^(.*?(?:^|{_BORDER}))' || regexp_escape(lower(term)) || '(?:$|{_BORDER})', 1) AS before
  FROM low JOIN own ON contains(t, lower(term))
  WHERE regexp_matches(t, '(?:^|{_BORDER})' || regexp_escape(lower(term)) || '(?:$|{_BORDER})')
)
SELECT doc_id, arg_min(substr(text, length(before) + 1, length(term)), length(before) * 1000 - length(term)) AS matched_phrase
FROM held GROUP BY doc_id
""")
def mention_extract_large(spark, sf):
    """A dictionary of two terms per part and some more, one with punctuation: more than one expression should hold."""
    names = table(spark, sf, "part").select("p_name")
    terms = names.select(F.explode(F.array("p_name", F.concat(F.lit("the "), "p_name"))).alias("term"))
    terms = terms.union(spark.createDataFrame([("idiot",), ("es",), ("of the,",)], "term string"))
    return matching.mentions(texts(spark, sf), "text", terms).select("doc_id", "matched_phrase")


_PART_CELLS = ["p_name", "p_brand", "p_type"]


@query(r"""
WITH patterns AS (
  SELECT DISTINCT concat_ws('|', nullif(trim(p_name), ''), nullif(trim(p_brand), ''), nullif(trim(p_type), '')) AS pattern
  FROM part
)
SELECT pattern, '\b' || replace(pattern, '|', '\b|\b') || '\b' AS bounded FROM patterns WHERE length(pattern) > 0
""")
def dictionary_patterns(spark, sf):
    return dictionary.bounded_patterns(dictionary.row_patterns(table(spark, sf, "part"), _PART_CELLS))


@query("""
SELECT DISTINCT unnest([trim(p_name), trim(p_brand), trim(p_type)]) AS term FROM part
""")
def dictionary_terms(spark, sf):
    return dictionary.terms(dictionary.row_patterns(table(spark, sf, "part"), _PART_CELLS))


@query("""
SELECT DISTINCT lower(c.term) AS term, trim(p.p_brand) AS owner
FROM part p, LATERAL (SELECT unnest([trim(p.p_name), trim(p.p_type)]) AS term) c
""")
def dictionary_term_owners(spark, sf):
    return dictionary.term_owners(table(spark, sf, "part"), ["p_name", "p_type"], owner="p_brand")


@query(f"""
WITH firms AS (SELECT s_name AS firm, row_number() OVER (ORDER BY s_name) - 1 AS i, count(*) OVER () AS n FROM supplier)
SELECT p.p_partkey AS post_id,
       replace([{", ".join("'" + t + "'" for t in TEMPLATES)}][CAST(p.p_partkey % {len(TEMPLATES)} AS INT) + 1], '{{}}', f.firm) AS content
FROM part p JOIN firms f ON f.i = p.p_partkey % f.n
""")
def template_expansion(spark, sf):
    posts = table(spark, sf, "part").select(F.col("p_partkey").alias("post_id"))
    firms = table(spark, sf, "supplier").select(F.col("s_name").alias("firm"))
    templates = spark.createDataFrame(list(enumerate(TEMPLATES)), "template_id bigint, template string")
    return generate.fill_templates(
        posts, "post_id", generate.numbered(firms, "firm"), generate.given_numbers(templates), by_hash=False
    ).select("post_id", "content")
