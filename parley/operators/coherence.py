"""Topic coherence c_v (Roeder et al. 2015) from boolean sliding windows that are never built.

The number of windows that hold a word, or both words of a pair, follows from where the words stand:
between two neighbouring positions the next occurrence of each word is fixed, so the window starts
in between are counted by subtraction.  Words meet the top words by a join, so the list of these may be of any length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.runtime import materialise, small_side

# Window width in words, smoothing of the logarithms.
WINDOW, EPSILON = 110, 1e-12


def window_counts(tokens: DataFrame, pairs: DataFrame, width: int = WINDOW) -> DataFrame:
    """``(a, b, n)``: windows that hold both words of a pair (``a = b`` for one word)."""
    legs = pairs.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("word"), "a", "b").distinct()
    hits = tokens.select(
        "ord", F.greatest(F.size("t") - width, F.lit(0)).alias("last_start"), F.posexplode("t").alias("pos", "word")
    )
    # from the last position to the first, so "the next one" is a running value
    backwards = Window.partitionBy("ord", "a", "b").orderBy(F.desc("pos"))
    so_far = backwards.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upcoming = lambda w: F.last(F.when(F.col("word") == F.col(w), F.col("pos")), ignorenulls=True).over(so_far)
    placed = hits.join(small_side(legs), "word").select(
        "a",
        "b",
        "pos",
        "last_start",
        upcoming("a").alias("na"),
        upcoming("b").alias("nb"),
        F.coalesce(F.lead("pos").over(backwards), F.lit(-1)).alias("before"),
    )
    both = F.when(F.col("na").isNotNull() & F.col("nb").isNotNull(), F.greatest("na", "nb"))
    starts = F.least("pos", "last_start") - F.greatest("before", both - width)
    return (
        placed.withColumn("n", F.when(both.isNull(), 0).otherwise(F.greatest(starts, F.lit(0))))
        .groupBy("a", "b")
        .agg(F.sum("n").alias("n"))
    )


def topic_coherence(tokens: DataFrame, top: DataFrame, width: int = WINDOW) -> DataFrame:
    """``(topic, coherence)``; ``tokens`` is ``(ord, t)``, ``top`` a few rows ``(topic, term)`` per topic."""
    words = materialise(top.select("topic", F.col("term").alias("w")).distinct(), "top-words")
    left = words.withColumnRenamed("w", "i")
    grid = left.join(words.withColumnRenamed("w", "j"), "topic")
    grid = grid.withColumns({"a": F.least("i", "j"), "b": F.greatest("i", "j")})
    counts = materialise(window_counts(tokens, grid.select("a", "b").distinct(), width), "window-counts")
    total = tokens.where(F.size("t") > 0).agg(F.sum(F.greatest(F.size("t") - width, F.lit(0)) + 1)).scalar()
    single = counts.where(F.col("a") == F.col("b")).select(F.col("a").alias("i"), F.col("n").alias("ni"))
    joined = (
        grid.join(counts, ["a", "b"], "left")
        .join(single, "i")
        .join(single.withColumnRenamed("i", "j").withColumnRenamed("ni", "nj"), "j")
    )
    p = lambda c: F.coalesce(F.col(c), F.lit(0)) / total
    npmi = F.log((p("n") + EPSILON) / (p("ni") * p("nj"))) / -F.log(p("n") + EPSILON)
    cells = materialise(joined.select("topic", "i", "j", npmi.alias("x")), "npmi")
    whole = cells.groupBy("topic", "j").agg(F.sum("x").alias("s"))
    per_word = (
        cells.join(whole, ["topic", "j"])
        .groupBy("topic", "i")
        .agg(
            F.sum(F.col("x") * F.col("s")).alias("dot"),
            F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("nx"),
            F.sqrt(F.sum(F.col("s") * F.col("s"))).alias("ns"),
        )
    )
    return per_word.groupBy("topic").agg(F.avg(F.try_divide("dot", F.col("nx") * F.col("ns"))).alias("coherence"))
