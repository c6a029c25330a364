"""The queries of this subpackage, with production parameters over their whole tables, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import decontaminate, html, langid, lines, mixing, near, quality, repeats, search, secrets, sharding, spelling, warc
from parley.runtime import scratch_path

# Wanted token shares; each margin is scaled over the values that occur.  Other values keep their observed share.
TARGETS = mixing.Targets(
    source={f"src{i}": 1.0 for i in range(20)},
    lang={"en": 0.56, "de": 0.16, "fr": 0.16, "es": 0.12},
    topic={"article": 0.49, "long": 0.47, "short": 0.02, "table": 0.02},
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(_table(spark, sf_dir, "documents"), near.Likeness(words=2))


def op2_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op4_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op5_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.fit_and_extract(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op7_raked_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), TARGETS)
    return mixed.select(
        "doc_id", "source", "lang", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("n_tokens"),
        F.col("mix_weight").alias("weight"), F.col("mix_probability").alias("probability"), F.col("mix_kept").alias("kept"),
    )


def op8_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    warc.write_archive(_table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op10_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op11_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.cut_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_near_duplicates, op2_quality_divergence, op3_line_dedup, op4_virtual_slots, op5_template_decontamination,
        op6_main_text, op7_raked_mix, op8_warc_archive, op9_secret_ownership, op10_compression_language,
        op11_ball_tree_search, op12_spelling_variants, op13_substring_dedup,
    )
}

ORACLE: dict[str, str] = {
    "op3_line_dedup": r"""
        WITH cut AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
        ), line AS (
            SELECT doc_id, unnest(ls) AS l, unnest(range(1, len(ls) + 1)) AS i FROM cut
        ), keyed AS (
            SELECT *, translate(trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM line
        ), common AS (
            SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
        ), marked AS (
            SELECT keyed.*, coalesce(keyed.doc_id <> keeper, false) AS gone FROM keyed LEFT JOIN common USING (k)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op8_warc_archive": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
        g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS holder FROM p)
        SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
               CASE WHEN n >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> holder THEN holder END AS refers_to
        FROM g
    """,
    "op11_ball_tree_search": r"""
        WITH term AS (
            SELECT doc_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents WHERE text IS NOT NULL
        ), size AS (
            SELECT doc_id, count(*)::BIGINT AS n FROM term GROUP BY doc_id
        ), corpus AS (
            SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM size
        ), held AS (
            SELECT doc_id, t, count(*)::BIGINT AS tf FROM term GROUP BY doc_id, t
        ), weight AS (
            SELECT t, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, corpus GROUP BY t
        ), asked AS (
            SELECT DISTINCT item_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
                                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM benchmark WHERE text IS NOT NULL
        ), scored AS (
            SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
            FROM asked JOIN weight USING (t) JOIN held USING (t) JOIN size USING (doc_id), corpus GROUP BY item_id, doc_id
        ), ranked AS (
            SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
    "op12_spelling_variants": r"""
        WITH RECURSIVE crc AS (
            SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
                   lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
        ), run AS (
            SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r FROM documents
        ), counted AS (
            SELECT coalesce(doc_id::VARCHAR, '') || ':' || r AS s, r, count(*) AS tf FROM run GROUP BY doc_id, r
        ), octets AS (
            SELECT r, tf, flatten(list_transform(string_split(s, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)]
                   ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS b FROM counted
        ), hashed AS (
            SELECT r, tf, xor(list_reduce(list_prepend(4294967295, b::BIGINT[]),
                   lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM octets, crc
        ), v AS (
            SELECT CASE WHEN h % 199 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word,
                   sum(tf)::BIGINT AS n
            FROM hashed GROUP BY 1 HAVING n >= 5 AND length(word) >= 6
        ), cut AS (
            SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)
        ), shorter AS (
            SELECT DISTINCT cut.word, cut.n, v.word AS near, v.n AS near_n FROM cut JOIN v ON cut.rest = v.word
        ), near AS (
            SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b USING (rest, i) WHERE a.word <> b.word
            UNION ALL SELECT word, n, near, near_n FROM shorter
            UNION ALL SELECT near, near_n, word, n FROM shorter
        ), best AS (
            SELECT word, count(*) AS n_near, arg_max(near, (near_n, -rank)) AS top, max(near_n) AS top_n
            FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near) AS rank
                  FROM (SELECT DISTINCT word, near, near_n FROM near)) GROUP BY word
        ), told AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 5 * n THEN top END AS form,
                   CASE WHEN top_n >= 5 * n THEN top_n END AS form_n
            FROM v LEFT JOIN best USING (word)
        ), chain AS (
            SELECT word, word AS reached FROM told
            UNION ALL SELECT chain.word, told.form FROM chain JOIN told ON told.word = chain.reached WHERE told.form IS NOT NULL
        )
        SELECT told.word, told.form, chain.reached AS root, told.n, told.n_near, told.form_n
        FROM told JOIN chain USING (word) JOIN told AS last ON last.word = chain.reached WHERE last.form IS NULL
    """,
    "op13_substring_dedup": r"""
        WITH cut AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), word AS (
            SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM cut
        ), windowed AS (
            SELECT doc_id, w, i, CASE WHEN count(*) OVER ahead = 20 THEN string_agg(w, ' ') OVER ahead END AS k FROM word
            WINDOW ahead AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
        ), again AS (
            SELECT doc_id, w, i, k IS NOT NULL AND row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS later FROM windowed
        ), marked AS (
            SELECT doc_id, w, i, bool_or(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
            FROM again
        )
        SELECT doc_id, count(w) AS n_words, count(*) FILTER (gone) AS n_removed,
               sha256(coalesce(string_agg(w, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM documents LEFT JOIN marked USING (doc_id) GROUP BY doc_id
    """,
}
