"""Dictionary terms as one regular expression."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.text import WORD


def alternation(terms: Iterable[str], literal: bool = True, ignore_case: bool = True) -> str:
    """One regex for all terms, longest first, on word boundaries.

    ``literal=False`` keeps regex characters in the terms alive.
    """
    ordered = sorted(set(terms), key=lambda t: (-len(t), t))
    flags = "iuU" if ignore_case else "uU"
    if literal:
        body = "|".join(re.sub(r"([^\w\s])", r"\\\1", t) for t in ordered)
        return f"(?{flags})(?<!{WORD})(?:{body})(?!{WORD})"
    return f"(?{flags})" + "|".join(rf"\b{t}\b" for t in ordered)


def leftmost_match(text: Column, pattern: str) -> Column:
    """The earliest match as it stands in the text; NULL without one."""
    return F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))
