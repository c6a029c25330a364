"""Text columns: tokens, n-grams, windows, sentences."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.wordlists import STOP_WORDS

WORD = r"[\p{L}\p{N}_]"


def words(text: Column, min_length: int = 2) -> Column:
    """Lower-case runs of letters, digits and underscores, ``min_length`` or longer."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD + f"{{{min_length},}}"), F.lit(0))


def content_words(text: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Words without stop words, order kept.  ``isin`` becomes a hash-set probe."""
    stop = list(stop_words)
    return F.filter(words(text), lambda w: ~w.isin(stop)) if stop else words(text)


def words_and_marks(text: Column) -> Column:
    """Words and single punctuation marks, case kept, for corpus BLEU."""
    return F.regexp_extract_all(text, F.lit(WORD + r"+|[^\p{L}\p{N}_\s]"), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often and deep ``body`` refers to it.

    A lambda that refers to an outer expression computes it again for every element; bound to a
    lambda variable it is a plain reference.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def joined_ahead(tokens: Column, i: Column, n: int) -> Column:
    """The ``n`` tokens from position ``i`` joined by blanks; NULL where they run past the end."""
    parts = [part for k in range(n) for part in (F.lit(" "), F.get(tokens, i + F.lit(k)))]
    return F.concat(*parts[1:])


def ngrams(tokens: Column, low: int = 1, high: int = 3) -> Column:
    """All n-grams of adjacent tokens, ``low`` to ``high`` tokens long, joined by a blank."""

    def of_length(t: Column, n: int) -> Column:
        if n == 1:
            return t
        return F.transform(t, lambda w, i: joined_ahead(t, i, n))

    return let(tokens, lambda t: F.array_compact(F.concat(*[of_length(t, n) for n in range(low, high + 1)])))


def sentences(text: Column) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by white space, and at line ends."""
    return F.filter(F.split(text, r"(?<=[.!?])\s+|\n+"), lambda s: F.length(F.trim(s)) > 0)


def windows(tokens: Column, width: int, stride: int) -> Column:
    """Array of ``(window, items)``: every ``stride`` tokens, up to ``width`` tokens."""

    def of(t: Column) -> Column:
        last = F.ceil(F.size(t) / F.lit(stride)).cast("int") - 1
        starts = F.when(F.size(t) > 0, F.sequence(F.lit(0), last))
        # get() is a plain index; slice() would copy the whole text's array for every window
        items = lambda w: F.array_compact(F.array(*[F.get(t, w * stride + F.lit(k)) for k in range(width)]))
        return F.transform(starts, lambda w: F.struct(w.alias("window"), items(w).alias("items")))

    return let(tokens, of)


def flesch_reading_ease(text: Column) -> Column:
    """206.835 - 1.015 words/sentences - 84.6 syllables/words; NULL without words.

    A syllable is a run of vowels; a word without one counts as one.
    """
    low = F.lower(text)
    n_words = F.regexp_count(low, F.lit(WORD + "+"))
    vowel_runs = F.regexp_count(low, F.lit("[aeiouy]+"))
    voiceless = F.regexp_count(
        low, F.lit(rf"(?<!{WORD})[\p{{L}}\p{{N}}_&&[^aeiouy]]+(?!{WORD})")
    )
    n_sentences = F.greatest(F.regexp_count(low, F.lit(r"[.!?]+(?:\s|$)")), F.lit(1))
    return F.when(
        n_words > 0,
        F.lit(206.835)
        - F.lit(1.015) * (n_words / n_sentences)
        - F.lit(84.6) * ((vowel_runs + voiceless) / n_words),
    )
