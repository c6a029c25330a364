"""Scores of labels and of generated texts: class report, ROUGE, BLEU, token match, readability."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.text import flesch_reading_ease, let, ngrams, words_and_marks
from parley.runtime import materialise, small_side

# Label order of the class report.
LABELS = ("NEGATIVE", "NEUTRAL", "POSITIVE")
# Words of a text that are compared with as many of the other at a time; characters of the texts whose words one task holds.
MATCH_BLOCK, MATCH_CHARS = 1024, 500_000


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return _or_zero(F.try_divide(2 * p * r, p + r))


# -- labels ------------------------------------------------------------------------------------


def class_metrics(df: DataFrame, true: str, predicted: str, labels: Sequence[str] = LABELS) -> DataFrame:
    """``(label, position, precision, recall, f1, support)`` per label in the given order.

    Labels are compared in upper case; undefined values are 0.  The table is first reduced to its
    confusion counts, all the rest works on those few rows.
    """
    counts = df.groupBy(F.upper(true).alias("t"), F.upper(predicted).alias("p")).agg(F.count("*").alias("n"))
    order = {label.upper(): i for i, label in enumerate(labels)}
    sides = F.explode(
        F.array(
            F.struct(F.col("t").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("guessed")),
            F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("guessed")),
        )
    )
    sums = (
        counts.select((F.col("t") == F.col("p")).alias("hit"), sides.alias("s"))
        .groupBy("s.label")
        .agg(
            F.sum(F.when(F.col("hit"), F.col("s.support"))).alias("tp"),
            F.sum("s.support").alias("support"),
            F.sum("s.guessed").alias("guessed"),
        )
    )
    wanted = df.sparkSession.createDataFrame(list(order.items()), "label string, position int")
    tp = F.coalesce("tp", F.lit(0))
    scored = wanted.join(sums, "label", "left").select(
        "label",
        "position",
        _or_zero(F.try_divide(tp, "guessed")).alias("precision"),
        _or_zero(F.try_divide(tp, "support")).alias("recall"),
        F.coalesce("support", F.lit(0)).alias("support"),
        tp.alias("tp"),
    )
    return scored.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def classification_report(df: DataFrame, true: str, predicted: str, labels: Sequence[str] = LABELS) -> DataFrame:
    """Class rows plus ``accuracy``, ``macro avg`` and ``weighted avg`` (accuracy in every score column)."""
    rows = class_metrics(df, true, predicted, labels)
    scores = ("precision", "recall", "f1")
    weighted = lambda c: _or_zero(F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")))
    accuracy = _or_zero(F.try_divide(F.sum("tp"), F.sum("support")))
    summary = rows.agg(
        F.sum("support").alias("support"),
        F.array(
            F.struct(F.lit("accuracy").alias("label"), *[accuracy.alias(c) for c in scores]),
            F.struct(F.lit("macro avg").alias("label"), *[F.avg(c).alias(c) for c in scores]),
            F.struct(F.lit("weighted avg").alias("label"), *[weighted(c).alias(c) for c in scores]),
        ).alias("lines"),
    ).select("support", F.inline("lines"))
    return rows.select("label", *scores, "support").unionByName(summary)


# -- texts -------------------------------------------------------------------------------------


def dialogue_pairs(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, reference, generated)``: a user turn and the assistant turn after it.

    Joined on the exact turn, which no two rows share, so a long conversation spreads like many short.
    """
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("reference"))
    answered = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("generated")
    )
    return asked.join(answered, ["conv_id", "turn"])


def plain_words(text: Column) -> Column:
    """White-space words with full stops taken out, case kept."""
    return F.filter(F.split(F.replace(text, F.lit("."), F.lit(" ")), r"\s+"), lambda w: F.length(w) > 0)


def rouge_n(pairs: DataFrame, n: int, reference: str = "reference", generated: str = "generated") -> DataFrame:
    """Add ``p``, ``r``, ``f`` of the distinct n-grams both texts share; map-only."""
    grams = lambda c: F.array_distinct(ngrams(plain_words(F.col(c)), n, n))
    both = pairs.withColumns({"_g": grams(generated), "_r": grams(reference)})
    shared = F.size(F.array_intersect("_g", "_r"))
    scored = both.withColumns(
        {"p": _or_zero(F.try_divide(shared, F.size("_g"))), "r": _or_zero(F.try_divide(shared, F.size("_r")))}
    )
    return scored.withColumn("f", _f1(F.col("p"), F.col("r"))).drop("_g", "_r")


def common_subsequence(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two word arrays, as a fold over the words of ``b``.

    The state holds, for every length, the first place of ``a`` where a common subsequence of that length ends
    (Hunt & Szymanski 1977), as the odd number ``2 * place + 1``.  A word's places in ``a``, as even numbers, are
    sorted into it: what follows a place of the word is replaced by it, what follows an end stays.
    """

    def places(x: Column, w: Column) -> Column:
        return F.array_compact(F.transform(x, lambda v, i: F.when(v == w, 2 * i)))

    def step(ends: Column, hits: Column) -> Column:
        merged = lambda s: F.filter(s, lambda _, i: (i == 0) | (F.get(s, i - 1) % 2 == 1))
        return F.transform(let(F.sort_array(F.concat(ends, hits)), merged), lambda v: v.bitwiseOR(F.lit(1)))

    def fold(p: Column, order: Column) -> Column:
        return F.aggregate(order, F.array().cast("array<int>"), lambda ends, k: step(ends, F.get(p, (k - 1).cast("int"))), F.size)

    def of(x: Column, y: Column, shared: Column) -> Column:
        order = F.filter(F.transform(y, lambda w: F.array_position(shared, w)), lambda k: k > 0)
        return let(F.transform(shared, lambda w: places(x, w)), lambda p: fold(p, order))

    return let(a, lambda x: let(b, lambda y: let(F.array_intersect(x, y), lambda shared: of(x, y, shared))))


def rouge_l(pairs: DataFrame, reference: str = "reference", generated: str = "generated") -> DataFrame:
    """Add ``p``, ``r``, ``f`` from the longest common word subsequence of the whole texts."""
    both = pairs.withColumns({"_g": plain_words(F.col(generated)), "_r": plain_words(F.col(reference))})
    both = both.withColumn("_c", common_subsequence("_g", "_r"))
    scored = both.withColumns(
        {"p": _or_zero(F.try_divide("_c", F.size("_g"))), "r": _or_zero(F.try_divide("_c", F.size("_r")))}
    )
    return scored.withColumn("f", _f1(F.col("p"), F.col("r"))).drop("_g", "_r", "_c")


def _bleu_counts(made: Sequence[str], given: Sequence[str], order: int) -> list[int]:
    """Clipped hits and n-grams of the made text for every order, and the length of the given one."""
    grams = lambda words, n: Counter(zip(*(words[k:] for k in range(n))))
    hits = [(grams(made, n) & grams(given, n)).total() for n in range(1, order + 1)]
    return [*hits, *(max(len(made) - n + 1, 0) for n in range(1, order + 1)), len(given)]


def corpus_bleu(
    pairs: DataFrame, key: Sequence[str], reference: str = "reference", generated: str = "generated", order: int = 4
) -> DataFrame:
    """One row ``bleu``: pooled clipped n-gram precision, brevity penalty, exponential smoothing.

    The n-grams of a pair are counted in the task that holds both texts and never become rows.  Only pairs that
    share their ``key`` with others, whose n-grams are counted together, are unnested, grouped where the join on ``key`` left them.
    """
    split = pairs.select(*key, words_and_marks(F.col(generated)).alias("gw"), words_and_marks(F.col(reference)).alias("rw"))
    split = split.withColumn("rows", F.count("*").over(Window.partitionBy(*key)))
    counts = [f"{name}{n}" for name in ("hit", "all") for n in range(1, order + 1)] + ["ref_len"]
    types = ", ".join(f"{c} bigint" for c in counts)

    @F.pandas_udf(types)
    def counted(made: pd.Series, given: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_bleu_counts(g, r, order) for g, r in zip(made, given)], columns=counts, dtype="int64")

    empty = F.array().cast("array<string>")
    alone = split.where("rows = 1").select(counted(F.coalesce("gw", empty), F.coalesce("rw", empty)).alias("c")).select("c.*")
    side = lambda c, s: F.transform(
        F.array(*[F.struct(F.lit(n).alias("n"), ngrams(F.col(c), n, n).alias("grams")) for n in range(1, order + 1)]),
        lambda x: F.struct(x["n"].alias("n"), x["grams"].alias("grams"), F.lit(s).alias("g")),
    )
    grams = (
        split.where("rows > 1")
        .select(*key, F.inline(F.concat(side("gw", 1), side("rw", 0))))
        .select(*key, "n", "g", F.explode("grams").alias("gram"))
        .groupBy(*key, "n", "gram")
        .agg(F.sum("g").alias("made"), F.sum(1 - F.col("g")).alias("given"))
    )
    of = lambda n, value: F.when(F.col("n") == n, value).otherwise(0)
    together = grams.select(
        *[of(n, F.least("made", "given")).alias(f"hit{n}") for n in range(1, order + 1)],
        *[of(n, F.col("made")).alias(f"all{n}") for n in range(1, order + 1)],
        of(1, F.col("given")).alias("ref_len"),
    )
    sums = alone.unionByName(together).agg(*[F.sum(c).alias(c) for c in counts])
    # the k-th order without a hit counts as 1 / (2**k * its n-grams)
    log_sum, misses = F.lit(0.0), F.lit(0)
    for n in range(1, order + 1):
        hit, total = F.col(f"hit{n}"), F.col(f"all{n}")
        misses = misses + F.when(hit == 0, 1).otherwise(0)
        log_sum = log_sum + F.when(hit == 0, -F.log(F.pow(F.lit(2.0), misses) * total)).otherwise(F.log(hit / total))
    penalty = F.when(F.col("all1") < F.col("ref_len"), F.exp(1 - F.col("ref_len") / F.col("all1"))).otherwise(1.0)
    score = F.when(F.col(f"all{order}") > 0, 100 * penalty * F.exp(log_sum / order)).otherwise(0.0)
    return sums.select(score.alias("bleu"))


def token_match(
    pairs: DataFrame, key: Sequence[str], vectors: DataFrame, reference: str = "reference", generated: str = "generated",
    block: int = MATCH_BLOCK, chars: int = MATCH_CHARS,
) -> DataFrame:
    """``(key, precision, recall, f1)``: every word matched to the most similar word of the other text.

    ``vectors`` is ``(token, vector)``; words without one are left out, a pair without words on one side scores 0.
    Distinct words of a pair are numbered and packed in blocks of at most ``block``; each block meets the other
    text's blocks one at a time and the greatest likeness of a word is kept, so no row holds a whole pair.
    Pairs, their words and their blocks are dealt out to as many tasks as hold ``chars`` characters each, so that the words
    and vectors a task holds do not grow with the table.
    """
    token = lambda c, s: F.transform(plain_words(F.coalesce(F.lower(c), F.lit(""))), lambda w: F.struct(w.alias("token"), F.lit(s).alias("side")))
    size = sum((F.coalesce(F.length(c), F.lit(0)) for c in (generated, reference)), F.lit(0).cast("bigint"))
    tasks = max((pairs.agg(F.sum(size)).first()[0] or 0) // chars + 1, pairs.sparkSession.sparkContext.defaultParallelism)
    # a key that many pairs share spreads by text, then by word
    copy = F.xxhash64(generated, reference)
    counted = (
        pairs.select(*key, generated, reference, copy.alias("copy"))
        .repartition(tasks, *key, "copy")
        .select(*key, "copy", F.inline(F.concat(token(generated, "g"), token(reference, "r"))))
        .groupBy(*key, "copy", "token", "side")
        .agg(F.count("*").alias("n"))
        .repartition(tasks, *key, "token")
        .groupBy(*key, "token", "side")
        .agg(F.sum("n").alias("n"))
    )
    counted = materialise(counted, "words")
    place = F.row_number().over(Window.partitionBy(*key).orderBy("side", "token"))
    placed = counted.repartition(tasks, *key).withColumn("block", F.floor((place - 1) / block).cast("int"))
    listed = vectors.select("token", "vector")
    known = small_side(listed)
    found = placed.join(known, "token")
    if known is listed:  # they met by the word, with a shuffle
        found = found.repartition(tasks, *key)
    blocks = found.groupBy(*key, "side", "block").agg(F.collect_list(F.struct("n", "vector")).alias("words"))
    of = lambda s: blocks.where(F.col("side") == s).select(
        *key, F.col("block").alias(f"{s}b"), F.col("words.n").alias(f"{s}n"), F.col("words.vector").alias(f"{s}v")
    )

    @F.pandas_udf("g array<double>, r array<double>")
    def likeness(gv: pd.Series, rv: pd.Series) -> pd.DataFrame:
        def unit(v) -> np.ndarray:
            m = np.stack(v).astype(np.float64)
            return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)

        # one tile at a time is held
        best = [(t.max(1), t.max(0)) for t in (unit(g) @ unit(r).T for g, r in zip(gv, rv))]
        return pd.DataFrame({"g": [g for g, _ in best], "r": [r for _, r in best]})

    met = of("g").join(of("r"), list(key)).withColumn("best", likeness("gv", "rv"))
    words = lambda s: F.transform(
        F.arrays_zip(F.col(f"{s}n").alias("n"), F.col(f"best.{s}").alias("best")),
        lambda w, i: F.struct(F.lit(s).alias("side"), F.col(f"{s}b").alias("block"), i.alias("i"), w["n"].alias("n"), w["best"].alias("best")),
    )
    best = met.select(*key, F.inline(F.concat(words("g"), words("r")))).groupBy(*key, "side", "block", "i").agg(
        F.first("n").alias("n"), F.max("best").alias("best")
    )
    mean = lambda s: F.sum(F.when(F.col("side") == s, F.col("n") * F.col("best"))) / F.sum(F.when(F.col("side") == s, F.col("n")))
    scored = best.groupBy(*key).agg(mean("g").alias("precision"), mean("r").alias("recall"))
    one_sided = blocks.groupBy(*key).agg(F.count_distinct("side").alias("sides")).where("sides = 1")
    scored = scored.unionByName(one_sided.select(*key, F.lit(0.0).alias("precision"), F.lit(0.0).alias("recall")))
    return scored.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def mean_token_match(scored: DataFrame) -> DataFrame:
    """One row of means over the pairs of ``token_match``; no pairs give nulls."""
    return scored.agg(*(F.avg(c).alias(c) for c in ("precision", "recall", "f1")))


def evaluate_summaries(pairs: DataFrame, key: Sequence[str], vectors: DataFrame | None = None) -> DataFrame:
    """One row of corpus means: ROUGE-1, -2 and -L (p, r, f), readability of the generated text, BLEU and, with
    ``vectors`` of the words, the token match.

    All scores of a pair without shuffle are columns of one pass; BLEU and the token match pool their own words.
    """
    scored, parts = pairs, ("p", "r", "f")
    for name, score in (("rouge1", lambda d: rouge_n(d, 1)), ("rouge2", lambda d: rouge_n(d, 2)), ("rougel", rouge_l)):
        scored = score(scored).withColumnsRenamed({c: f"{name}_{c}" for c in parts})
    means = [F.avg(f"{name}_{c}").alias(f"{name}_{c}") for name in ("rouge1", "rouge2", "rougel") for c in parts]
    readable = F.avg(flesch_reading_ease(F.col("generated"))).alias("readability")
    report = scored.agg(*means, readable).withColumn("bleu", corpus_bleu(pairs, key).scalar())
    if vectors is None:
        return report
    matched = mean_token_match(token_match(pairs, key, vectors))
    means = matched.select(F.struct("*")).scalar()
    return report.withColumns({f"match_{c}": means[c] for c in matched.columns})
