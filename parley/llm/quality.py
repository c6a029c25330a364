"""Quality rules by distribution divergence, in column expressions only.

Every text gets a histogram of character classes and one of the common words of its language.  Languages are the values
of the language column: the words most texts of a language hold are learned from all of them, and every
language with enough texts that pass the base rules gets a reference, the mean of all of these with the same weight each.
A text that is long enough to judge fails if its Jensen-Shannon distance to the reference of its language is too large.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.keys import top_per_group
from parley.runtime import materialise

# Taken out of a text one after the other, the most frequent first; a class may come again for other scripts.
CUTS = (
    ("lower", r"[a-z]+"),
    ("blank", r"[\x20\x09-\x0D]+"),
    ("stop", r"[.,;:!?]+"),
    ("upper", r"[A-Z]+"),
    ("digit", r"[0-9]+"),
    ("symbol", r"[#*$%&|<>]+"),
    ("mark", r"[\x21-\x7E]+"),
    ("lower", r"\p{Ll}+"),
    ("upper", r"\p{Lu}+"),
    ("letter", r"[\p{L}\p{M}]+"),
    ("digit", r"\p{N}+"),
    ("stop", r"[\u3001\u3002\uFF01\uFF0C\uFF1A\uFF1B\uFF1F\u060C\u061B\u061F\u06D4\u0964\u2026]+"),
    ("mark", r"[\p{P}\p{S}]+"),
)
LETTERS = ("lower", "upper", "letter")
CLASSES = (*LETTERS, "stop", "digit", "symbol", "mark")
EDGE = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
PPM = 1_000_000


@dataclass(frozen=True)
class Rules:
    """``min_words`` and ``min_chars`` guard short texts; the distances lie between 0 and 1.

    ``top_words`` words of a language, each in at least ``min_share`` of its texts of ten words or more;
    ``min_rows`` texts that pass the base rules make a reference.
    """

    min_words: int = 50
    min_chars: int = 200
    max_class_distance: float = 0.25
    max_word_distance: float = 0.5
    top_words: int = 10
    min_share: float = 0.2
    min_rows: int = 10


def trie(words: list[str]) -> str:
    """A pattern of the given words that tries each first letter once."""
    tails: dict[str, list[str]] = {}
    for word in words:
        if word:
            tails.setdefault(word[0], []).append(word[1:])
    branches = [re.escape(letter) + trie(rest) for letter, rest in sorted(tails.items())]
    body = branches[0] if len(branches) == 1 and "" not in words else f"(?:{'|'.join(branches)})" if branches else ""
    return body + "?" if "" in words and branches else body


def common_word(words: list[str]) -> str:
    """A pattern for one of the words with nothing but punctuation round it."""
    return r"(?<![\p{L}\p{N}])" + trie(words) + r"(?![\p{L}\p{N}])"


def _table(values: dict[str, list], kind: str) -> Column:
    """A constant map from language to list."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast(f"array<array<{kind}>>"))
    if not values:
        return empty
    return F.create_map(*(c for k, v in sorted(values.items()) for c in (F.lit(k), F.array(*map(F.lit, v)).cast(f"array<{kind}>"))))


def _longs(*columns: Column) -> Column:
    return F.array(*(c.cast("long") for c in columns))


def _share(counts: str) -> Column:
    """Counts in parts per million of their sum, rounded down, so that sums over texts are exact."""
    total = F.greatest(F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(1))
    return F.transform(counts, lambda x: F.floor(x * PPM / total))


def _rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t")
    )


def _words(text: str) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda x: x != "")


def features(rows: DataFrame, words: dict[str, list[str]]) -> DataFrame:
    """The base counts and both histograms per row: ``classes`` in the order of CLASSES, then the rest; ``words`` in that of the language's words, then the rest."""
    # What the length loses when a class is taken out is its count.
    rows = rows.withColumn("left0", F.col("t"))
    for i, (_, pattern) in enumerate(CUTS):
        rows = rows.withColumn(f"left{i + 1}", F.regexp_replace(f"left{i}", pattern, ""))
    left = [F.length(f"left{i}") for i in range(len(CUTS) + 1)]
    sizes: dict[str, Column] = {}
    for (name, _), a, b in zip(CUTS, left, left[1:]):
        sizes[name] = sizes[name] + (a - b) if name in sizes else a - b
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    every = sorted({w for some in words.values() for w in some})
    common = F.regexp_extract_all(F.lower("t"), F.lit(common_word(every)), F.lit(0)) if every else F.array().cast("array<string>")
    rows = rows.select(
        "doc_id", "lang", (left[0] - sizes["blank"]).cast("long").alias("word_chars"),
        sizes["symbol"].cast("long").alias("n_symbols"),
        _longs(*(sizes[name] for name in CLASSES), left[-1]).alias("classes"),
        lines.alias("lines"), F.transform(_words("t"), lambda x: F.xxhash64(x)).alias("w"),
        F.concat(F.lit(" "), F.array_join(common, "  "), F.lit(" ")).alias("common"),
        F.element_at(_table(words, "string"), F.col("lang")).alias("own"),
    )
    hashes = F.transform(F.sequence(F.lit(0), F.size("w") - 5), lambda i: F.xxhash64(*(F.get("w", i + j) for j in range(5))))
    rows = rows.select(
        "doc_id", "lang", "word_chars", "n_symbols", "classes", "common", "own", F.size("w").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") >= 5, hashes).alias("h"),
    )
    # Only texts with a window twice are worth sorting.
    twice = F.size(F.array_distinct("h")) < F.size("h")
    ranked = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    rows = rows.withColumn("ranked", F.when(twice, ranked)).drop("h")
    again = F.filter(
        F.transform(
            "ranked",
            lambda x, k: F.when(
                x.h.eqNullSafe(F.get("ranked", k - 1).h) | x.h.eqNullSafe(F.get("ranked", k + 1).h), x.i
            ),
        ),
        lambda i: i.isNotNull(),
    )
    # A word's places in the list of common words, as what the list loses without it.
    lost = lambda word: F.length("common") - F.length(F.replace("common", F.concat(F.lit(" "), word, F.lit(" ")), F.lit("")))
    counts = F.transform("own", lambda word: (lost(word) / (F.length(word) + 2)).cast("long"))
    rows = rows.withColumn("again", F.sort_array(again)).withColumn("counts", counts).drop("ranked", "common", "own")
    covered = F.aggregate(
        F.transform("again", lambda p, k: F.least(F.lit(5), F.coalesce(F.get("again", k + 1) - p, F.lit(5)))), F.lit(0), lambda a, x: a + x
    )
    named = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = rows.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), "classes",
        F.concat("counts", F.array(F.greatest(F.col("n_words") - named, F.lit(0)))).alias("words"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def common_words(rows: DataFrame, rules: Rules) -> dict[str, list[str]]:
    """Per language the words that most texts hold, from all its texts of at least ten words; a list for every language with enough of them."""
    # Every distinct word of a text counts once; the empty word counts the texts, so it comes first in its language.
    raw = F.array_distinct(_words(F.lower("t")))
    bare = F.filter(F.array_distinct(F.transform(raw, lambda x: F.regexp_replace(x, EDGE, ""))), lambda x: x != "")
    texts = rows.where("lang is not null").where(F.size(_words("t")) >= 10)
    held = texts.select("lang", F.explode(F.concat(F.array(F.lit("")), bare)).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("docs"))
    first = top_per_group(held, ["lang"], [F.desc("docs"), "word"], rules.top_words + 1, "place")
    found = first.withColumn("texts", F.max("docs").over(Window.partitionBy("lang"))).where(F.col("texts") >= rules.min_rows)
    enough = F.when((F.col("word") != "") & (F.col("docs") >= rules.min_share * F.col("texts")), F.struct("place", "word"))
    # One row per language that has enough rows.
    lists = found.groupBy("lang").agg(F.sort_array(F.collect_list(enough)).alias("top")).collect()
    return {r.lang: [w.word for w in r.top] for r in lists}


def references(rows: DataFrame, words: dict[str, list[str]], rules: Rules) -> dict[str, tuple[list[float], list[float]]]:
    """Mean class and word shares of all texts of each language that pass the base rules; one row per language."""
    good = rows.where(~F.col("base_failed") & F.col("words").isNotNull()).select("lang", _share("classes").alias("c"), _share("words").alias("w"))
    sums = lambda column, n: F.array(*(F.sum(F.get(column, F.lit(i))) for i in range(n)))
    longest = max(map(len, words.values()), default=0) + 1
    out = good.groupBy("lang").agg(F.count("*").alias("n"), sums("c", len(CLASSES) + 1).alias("c"), sums("w", longest).alias("w"))
    unit = lambda values: [v / max(sum(values), 1) for v in values]
    rows = out.where(F.col("n") >= rules.min_rows).collect()
    return {r.lang: (unit(r.c), unit(r.w[: len(words[r.lang]) + 1])) for r in rows}


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2) of a histogram of counts to one of shares; null if either is."""
    total = F.greatest(F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(1))
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    terms = F.zip_with(F.transform(counts, lambda x: x / total), reference, lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2))
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2
    return F.sqrt(F.when(total < 0, 0.0).otherwise(total))


def _merged(classes: list[float]) -> list[float]:
    return [sum(classes[: len(LETTERS)]), *classes[len(LETTERS) :]]


def judge(docs: DataFrame, rules: Rules = Rules(), **columns: str) -> DataFrame:
    """``doc_id``, the base counts, ``class_distance, word_distance, base_failed, kept`` per row.

    A text fails the base rules with fewer than 10 words, or with more than a fifth of its words in 5-word windows that the
    text repeats.  One that passes is kept unless it is long enough to judge and too far from its language's reference in
    classes or words.  A text without a language has no words to compare: its classes, all letters as one, are compared with
    the nearest reference.  A text below the guards, of a language without a reference, or of a corpus without any, keeps the
    base verdict and has null distances.

    A null text is an empty one.  Every row is judged and counted, also under a repeated or null id; texts are read whole, at
    any length; an empty table gives no rows; columns of the table other than the three named are not looked at, whatever their
    names.  Equally frequent words are taken in the order of their characters.
    """
    rows = _rows(docs, **columns)
    words = common_words(rows, rules)
    rows = materialise(features(rows, words), "features")
    known = references(rows, words, rules)
    classes, common = ({lang: pair[i] for lang, pair in known.items()} for i in (0, 1))
    enough = (F.col("n_words") >= rules.min_words) & (F.col("word_chars") >= rules.min_chars)
    letters = F.aggregate(F.slice("classes", 1, len(LETTERS)), F.lit(0).cast("long"), lambda a, x: a + x)
    merged = F.concat(F.array(letters), F.slice("classes", len(LETTERS) + 1, len(CLASSES) + 1 - len(LETTERS)))
    nearest = F.lit(None).cast("double")
    if known:
        others = F.array(*(F.array(*map(F.lit, _merged(c))) for _, c in sorted(classes.items())))
        nearest = F.array_min(F.transform(others, lambda r: distance(F.col("merged"), r)))
    own = lambda counts, table: distance(F.col(counts), F.element_at(_table(table, "double"), F.col("lang")))
    rows = rows.withColumn("merged", merged)
    rows = rows.withColumn("class_distance", F.when(enough, F.when(F.col("lang").isNull(), nearest).otherwise(own("classes", classes))))
    rows = rows.withColumn("word_distance", F.when(enough, own("words", common)))
    far = F.coalesce(F.col("class_distance") > rules.max_class_distance, F.lit(False)) | F.coalesce(F.col("word_distance") > rules.max_word_distance, F.lit(False))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "base_failed",
        (~F.col("base_failed") & ~far).alias("kept"),
    )
