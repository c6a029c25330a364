"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell of (source, language, topic).  The cells' weights are raked in turn to the
target share of every source, language and topic until all three margins hold; the ratio of a cell's
raked share to its own share is its calibrated weight.  Documents are then sampled with a probability in
proportion to that weight, at most 1.  Values without a target of their own are raked together as ``other``,
which keeps its observed share, so the number of cells is bounded by the targets and not by the data.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER = "other"
MARGINS = ("source", "lang", "topic")

# Topics of the query and the pipeline: the form of a text, read off its characters.
LONG_CHARS = 4000


def form_topic(text: str) -> Column:
    """A topic for tables that have none: ``table``, ``short``, ``article`` or ``long``, from the whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    cells = F.length(t) - F.length(F.replace(t, F.lit("|"), F.lit("")))
    return (
        F.when(cells * 50 > F.length(t), "table")
        .when(F.length(t) >= LONG_CHARS, "long")
        .when(F.length(t) >= 600, "article")
        .otherwise("short")
    )


def tokens(text: str) -> Column:
    """Words of a text, as the unit of weight; at least 1."""
    t = F.trim(F.translate(F.coalesce(F.col(text), F.lit("")), "\t\n\x0b\x0c\r", "     "))
    gaps = F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit("")))
    return (gaps + 1).cast("long")


@dataclass(frozen=True)
class Targets:
    """Wanted token shares per margin; each is scaled to a sum of 1 over the values that occur."""

    source: Mapping[str, float]
    lang: Mapping[str, float]
    topic: Mapping[str, float]


def _shares(targets: Mapping[str, float], values: list[str], own: np.ndarray) -> np.ndarray:
    """Wanted share per occurring value.  ``other`` without a target of its own keeps its observed share."""
    share = np.array([targets.get(v, 0.0) for v in values], float)
    kept = np.array([v == OTHER and OTHER not in targets for v in values])
    if not share.sum():
        return own
    return np.where(kept, own, share / share.sum() * (1 - own[kept].sum()))


def _filled(share: np.ndarray, room: np.ndarray, total: float) -> np.ndarray:
    """``total`` dealt out by ``share``; a value with less ``room`` is filled up and the others take the rest."""
    full = np.zeros(len(share), bool)
    for _ in share:
        free = np.where(full, 0.0, share)
        wanted = free / (free.sum() or 1.0) * (total - room[full].sum())
        over = ~full & (wanted > room)
        if not over.any():
            break
        full |= over
    return np.where(full, room, wanted)


def _margins(keys: list[tuple[str, str, str]], own: np.ndarray, targets: Targets) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per margin: the value's place of every cell, the wanted and the observed share of every value."""
    out = []
    for axis, margin in enumerate(MARGINS):
        values = sorted({k[axis] for k in keys})
        place = np.array([values.index(k[axis]) for k in keys])
        seen = np.bincount(place, own, len(values))
        out.append((place, _shares(getattr(targets, margin), values, seen), seen))
    return out


def covered(cells: Mapping[tuple[str, str, str], int], targets: Targets) -> float:
    """The share of the tokens that the targets ask for: what no value has beyond its target, in the scarcest margin."""
    keys = sorted(cells)
    if not keys:
        return 0.0
    own = np.array([cells[k] for k in keys], float)
    return min(float(np.minimum(share, seen).sum()) for _, share, seen in _margins(keys, own / own.sum(), targets))


def rake(cells: Mapping[tuple[str, str, str], int], targets: Targets, rounds: int = 500, tolerance: float = 1e-9, part: float | None = None) -> dict[tuple[str, str, str], float]:
    """Calibrated weight per cell: raked share over own share.  A target of 0 gives weight 0.

    With ``part``, the share of all tokens that the mix shall have, no weight exceeds ``1 / part``: cells and
    values with less than they should give are taken whole, and the others share out the rest.
    """
    keys = sorted(cells)
    if not keys:
        return {}
    own = np.array([cells[k] for k in keys], float)
    own /= own.sum()
    most = np.full(len(own), np.inf) if not part else own / part
    fit = own.copy()
    margins = []
    for place, share, seen in _margins(keys, own, targets):
        margins.append((place, share if not part else _filled(share, seen / part, 1.0)))
    for _ in range(rounds):
        before = fit
        for place, share in margins:
            sums = np.bincount(place, fit, len(share))
            fit = np.minimum(most, fit * np.divide(share, sums, out=np.zeros(len(share)), where=sums > 0)[place])
        if np.abs(fit - before).max() < tolerance:
            break
    return dict(zip(keys, (fit / own).tolist()))


def drawn(docs: DataFrame, targets: Targets, topic: Column | None = None, budget_tokens: int | None = None, seed: int = 17, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (all given columns as a struct), ``mix_source, mix_lang, mix_topic, mix_tokens, mix_weight, mix_probability, mix_kept``.

    The probability of a cell is its weight times the part of all tokens that the mix shall have: the tokens
    the targets ask for (``covered``), or ``budget_tokens``, if that is less.  Scarce cells and values are
    kept whole, at probability 1, so they do not thin the others; ``rake`` shares out the rest.  ``mix_kept``
    compares the probability with a hash of the id, so a document's fate does not depend on the partitions,
    and rows repeated under one id share it; rows without an id are drawn by their text.  A null source or language
    counts as ``other``, as does one without a target; a null or empty text weighs one token.  Without ``topic`` the
    form of the text is taken.  Given columns may have any names; an empty table gives no rows.  Two passes over the
    texts, whole, no shuffle of them.
    """
    listed = lambda column, names: F.when(column.isin(list(names)), column).otherwise(F.lit(OTHER))
    topic = form_topic(text_col) if topic is None else topic
    rows = docs.select(
        F.struct("*").alias("row"),
        listed(F.col("source"), targets.source).alias("mix_source"),
        listed(F.col("lang"), targets.lang).alias("mix_lang"),
        listed(topic, targets.topic).alias("mix_topic"),
        tokens(text_col).alias("mix_tokens"),
        F.when(F.col(id_col).isNull(), F.xxhash64(text_col, F.lit(seed))).otherwise(F.xxhash64(id_col, F.lit(seed))).alias("mix_draw"),
    )
    names = ["mix_source", "mix_lang", "mix_topic"]
    sums = rows.groupBy(*names).agg(F.sum("mix_tokens").alias("t")).collect()
    cells = {(r[0], r[1], r[2]): r.t for r in sums}
    part = covered(cells, targets)
    if budget_tokens is not None and cells:
        part = min(part, budget_tokens / sum(cells.values()))
    weights = rake(cells, targets, part=part) if part else dict.fromkeys(cells, 0.0)
    table = [(*k, w, min(1.0, w * part)) for k, w in weights.items()]
    schema = "mix_source string, mix_lang string, mix_topic string, mix_weight double, mix_probability double"
    table = docs.sparkSession.createDataFrame(table, schema)
    draw = F.pmod("mix_draw", F.lit(1 << 52)) / F.lit(float(1 << 52))
    rows = rows.join(F.broadcast(table), names).withColumn("mix_kept", draw < F.col("mix_probability"))
    return rows.drop("mix_draw")


def mix(docs: DataFrame, targets: Targets, topic: Column | None = None, **how) -> DataFrame:
    """``docs`` with the ``mix_`` columns of ``drawn``; given columns of these names give way to them."""
    rows = drawn(docs, targets, topic, **how)
    own = [c for c in rows.columns if c != "row"]
    given = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in own]
    return rows.select(*given, *own)
