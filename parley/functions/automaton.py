"""Dictionary terms as one Aho-Corasick automaton: any number of terms, one pass over a text.

Matches are those of ``patterns.alternation``: literal, without regard to case, between borders of words, the leftmost
and of these the longest.  Case is folded letter by letter, so places in the folded text are places in the text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby
from unicodedata import category

import ahocorasick


@lru_cache(maxsize=1 << 16)
def _folded(letter: str) -> str:
    upper = letter.upper()
    return (upper if len(upper) == 1 else letter).lower()[0]


def fold(text: str) -> str:
    """Lower case, letter by letter: the length stays."""
    return text.lower() if text.isascii() else "".join(map(_folded, text))


@lru_cache(maxsize=1 << 16)
def _in_word(letter: str) -> bool:
    return letter == "_" or category(letter)[0] in "LN"


def bounded(text: str, begin: int, end: int) -> bool:
    """No letter, digit or underscore stands right before ``begin`` or at ``end``."""
    return not (begin and _in_word(text[begin - 1])) and not (end < len(text) and _in_word(text[end]))


class Terms:
    """The automaton of some terms; it can be sent to tasks."""

    def __init__(self, terms: Iterable[str]):
        self.machine = ahocorasick.Automaton()
        self.longest = 0
        for term in terms:
            if term:
                self.machine.add_word(fold(term), len(term))
                self.longest = max(self.longest, len(term))
        if self.longest:
            self.machine.make_automaton()

    def first(self, text: str | None) -> str | None:
        """The leftmost match, of equal starts the longest, as it stands in ``text``; None without one."""
        if not text or not self.longest:
            return None
        folded, best = fold(text), None
        for last, length in self.machine.iter(folded):
            begin = last + 1 - length
            if best and last + 1 - self.longest > best[0]:
                break
            if (best is None or (begin, -length) < best) and bounded(folded, begin, last + 1):
                best = begin, -length
        return text[best[0] : best[0] - best[1]] if best else None


def word_runs(text: str) -> Iterator[tuple[str, int]]:
    """Runs of letters, digits and underscores with their places."""
    for word, letters in groupby(enumerate(text), lambda p: _in_word(p[1])):
        if word:
            held = list(letters)
            yield "".join(c for _, c in held), held[0][0]


def anchor(term: str) -> tuple[str, int] | None:
    """The longest word of a folded term and its place; where the term stands between borders, so does this word."""
    return max(word_runs(term), key=lambda r: (len(r[0]), -r[1]), default=None)
