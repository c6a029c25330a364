"""Lexicon sentiment: valences adjusted by the three words before them, summed per text.

Every word becomes one narrow row that already carries its neighbours, so the look-back needs no
window.  The lexicon is joined map-side and the words of a text are summed in the task that read it:
one row per text is shuffled, never its words.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import wordlists as fixed
from parley.runtime import small_side

# Punctuation that may stand at one end of a word, and the characters no word has.
EDGE_MARKS = r"[.!?,;:'\"-]|!!|!!!|\?\?|\?\?\?|\?!\?|!\?!|\?!\?!|!\?!\?"
EDGE_CHARACTERS = list(".!?,;:'\"-")
MARK_CLASS = r"!-/:-@\[-`{-~"
EDGE_PATTERN = rf"^(?:{EDGE_MARKS})([^{MARK_CLASS}]{{2,}})$|^([^{MARK_CLASS}]{{2,}})(?:{EDGE_MARKS})$"


# Up to this many lexicon words are also put into the query as a set.
PROBE_LIMIT = 20_000


def default_lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fixed.VALENCE.items()), "token string, valence double")


def spoken_words(text: Column) -> Column:
    """White-space tokens of two or more characters, one punctuation group off either end."""
    parts = F.filter(F.split(text, r"[\s\p{Z}]+"), lambda w: F.length(w) > 1)
    marked = lambda w: F.left(w, F.lit(1)).isin(EDGE_CHARACTERS) | F.right(w, F.lit(1)).isin(EDGE_CHARACTERS)
    # most words have nothing to strip; a look at both ends is far cheaper than the pattern
    return F.transform(parts, lambda w: F.when(marked(w), F.regexp_replace(w, EDGE_PATTERN, "$1$2")).otherwise(w))


def _shouted(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


def _punctuation(text: Column) -> Column:
    exclaim = F.least(F.regexp_count(text, F.lit("!")), F.lit(fixed.EXCLAMATION_MAX)) * fixed.EXCLAMATION_STEP
    asked = F.regexp_count(text, F.lit(r"\?"))
    question = (
        F.when(asked <= 1, 0.0).when(asked <= 3, asked * fixed.QUESTION_STEP).otherwise(fixed.QUESTION_CEILING)
    )
    return exclaim + question


def label(compound: Column) -> Column:
    return (
        F.when(compound >= fixed.POSITIVE_FROM, "POSITIVE")
        .when(compound <= fixed.NEGATIVE_TO, "NEGATIVE")
        .otherwise("NEUTRAL")
    )


def sentiment_scores(df: DataFrame, key: str, text: str, lexicon: DataFrame | None = None) -> DataFrame:
    """``(key, neg, neu, pos, compound, sentiment)``, one row per text; an empty text is neutral."""
    lexicon = default_lexicon(df.sparkSession) if lexicon is None else lexicon
    rule_words = fixed.INTENSIFIERS + fixed.DAMPENERS + fixed.NEGATIONS
    # rule words that carry a valence of their own do not act on their neighbours
    valued = {r[0] for r in lexicon.where(F.col("token").isin(rule_words)).select("token").distinct().collect()}
    acting = lambda listed: [w for w in listed if w not in valued]

    def degree(word: Column) -> Column:
        low = F.lower(word)
        return (
            F.when(low.isin(acting(fixed.INTENSIFIERS)), fixed.DEGREE_STEP)
            .when(low.isin(acting(fixed.DAMPENERS)), -fixed.DEGREE_STEP)
            .otherwise(0.0)
        )

    def negates(word: Column) -> Column:
        low = F.lower(word)
        return F.coalesce(low.isin(acting(fixed.NEGATIONS)) | low.contains("n't"), F.lit(False))

    # a lexicon of ordinary size doubles as a hash-set probe, so only its words become rows
    known = [r[0] for r in lexicon.select("token").limit(PROBE_LIMIT + 1).collect()]
    valued_word = (lambda w: F.lower(w).isin(known)) if len(known) <= PROBE_LIMIT else (lambda w: F.lit(True))

    # explode(array(...)) computes the token array once and makes it a plain column
    texts = df.select(
        F.col(key).alias("key"),
        _punctuation(F.coalesce(F.col(text), F.lit(""))).alias("punctuation"),
        F.explode(F.array(spoken_words(F.coalesce(F.col(text), F.lit(""))))).alias("t"),
    ).select(
        "key",
        "punctuation",
        F.size(F.filter("t", _shouted)).between(1, F.size("t") - 1).alias("mixed"),
        F.array_position(F.transform("t", F.lower), "but").alias("but_at"),
        F.size("t").alias("n"),
        "t",
    )
    back = lambda i, k: F.get("t", i - F.lit(k))
    around = lambda w, i: F.struct(
        (i + F.lit(1)).alias("at"), w.alias("word"), F.get("t", i + F.lit(1)).alias("after"),
        back(i, 1).alias("p1"), back(i, 2).alias("p2"), back(i, 3).alias("p3"),
    )
    spoken = texts.select(
        "key", "punctuation", "mixed", "but_at", "n",
        F.inline_outer(F.array_compact(F.transform("t", lambda w, i: F.when(valued_word(w), around(w, i))))),
    )

    low = F.lower("word")
    neutral = low.isin(fixed.INTENSIFIERS + fixed.DAMPENERS) | ((low == "kind") & (F.lower("after") == "of"))
    scored = spoken.join(small_side(lexicon.select("token", "valence")), low == F.col("token"), "left").select(
        "key", "punctuation", "mixed", "but_at", "n", "at", "p1", "p2", "p3",
        F.when(F.coalesce(neutral, F.lit(False)) | F.col("valence").isNull(), 0.0)
        .when(F.col("mixed") & _shouted(F.col("word")), F.col("valence") + F.signum("valence") * fixed.CAPITALS_STEP)
        .otherwise(F.col("valence"))
        .alias("v"),
    )
    p1, p2, p3 = (F.lower(p) for p in ("p1", "p2", "p3"))
    so_this = lambda p: p.isin("so", "this")
    never = lambda k: {
        1: (F.lit(False), 1.0),
        2: ((p2 == "never") & so_this(p1), 1.5),
        3: ((p3 == "never") & (so_this(p2) | so_this(p1)), 1.25),
    }[k]
    for k, damping in enumerate(fixed.LOOK_BACK_DAMPING, start=1):
        word, v = F.col(f"p{k}"), F.col("v")
        step = degree(word) * F.when(v < 0, -1.0).otherwise(1.0)
        loud = F.when(
            (degree(word) != 0.0) & F.col("mixed") & _shouted(word),
            F.when(v > 0, fixed.CAPITALS_STEP).otherwise(-fixed.CAPITALS_STEP),
        ).otherwise(0.0)
        active = (v != 0.0) & word.isNotNull()
        scored = scored.withColumn("v", F.when(active, v + (step + loud) * damping).otherwise(v))
        idiom, factor = never(k)
        scored = scored.withColumn(
            "v",
            F.when(~active, v)
            .when(F.coalesce(idiom, F.lit(False)), v * factor)
            .when(negates(word), v * fixed.NEGATION_FACTOR)
            .otherwise(v),
        )
    least = (p1 == "least") & ~F.coalesce(p2.isin("at", "very"), F.lit(False))
    v = F.col("v") * F.when(F.coalesce(least, F.lit(False)), fixed.NEGATION_FACTOR).otherwise(1.0)
    v = v * (
        F.when(F.col("but_at") == 0, 1.0)
        .when(F.col("at") < F.col("but_at"), fixed.BEFORE_BUT)
        .when(F.col("at") > F.col("but_at"), fixed.AFTER_BUT)
        .otherwise(1.0)
    )
    sums = (
        scored.withColumn("v", v)
        .groupBy("key")
        .agg(
            F.max("punctuation").alias("punctuation"),
            F.sum("v").alias("total"),
            F.sum(F.when(F.col("v") > 0, F.col("v") + 1).otherwise(0.0)).alias("up"),
            F.sum(F.when(F.col("v") < 0, 1 - F.col("v")).otherwise(0.0)).alias("down"),
            (F.max("n") - F.count_if(F.col("v") != 0)).alias("flat"),
        )
    )
    emphasis = F.col("punctuation")
    total = F.col("total") + F.signum("total") * emphasis
    up = F.col("up") + F.when(F.col("up") > F.col("down"), emphasis).otherwise(0.0)
    down = F.col("down") + F.when(F.col("up") < F.col("down"), emphasis).otherwise(0.0)
    whole = up + down + F.col("flat")
    share = lambda part: F.coalesce(F.round(F.try_divide(part, whole), 3), F.lit(0.0))
    compound = F.round(F.col("s") / F.sqrt(F.col("s") * F.col("s") + fixed.NORMALISER), 4)
    return (
        sums.withColumn("s", F.coalesce(total, F.lit(0.0)))
        .select(
            F.col("key").alias(key),
            share(down).alias("neg"),
            share(F.col("flat").cast("double")).alias("neu"),
            share(up).alias("pos"),
            compound.alias("compound"),
        )
        .withColumn("sentiment", label(F.col("compound")))
    )


def with_sentiment(df: DataFrame, key: str, text: str, lexicon: DataFrame | None = None) -> DataFrame:
    """``df`` plus ``sentiment_scores`` (struct), ``compound`` and ``sentiment``."""
    scores = sentiment_scores(df, key, text, lexicon)
    packed = scores.select(
        key, F.struct("neg", "neu", "pos", "compound").alias("sentiment_scores"), "compound", "sentiment"
    )
    return df.join(packed, key)


def lexicon_frame(spark: SparkSession, valences: Mapping[str, float]) -> DataFrame:
    return spark.createDataFrame([(t.lower(), float(v)) for t, v in valences.items()], "token string, valence double")
