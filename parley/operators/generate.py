"""Deterministic template expansion: one sentence per row with a name filled in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.operators.keys import dense_order


def numbered(df: DataFrame, order: str) -> DataFrame:
    """Number the rows 0..n-1 in order (``slot``) and carry n (``slots``); equal values are numbered one after the other."""
    slots = dense_order(df, [order], "slot")
    return slots.withColumn("slots", F.lit(df.count()))


def given_numbers(templates: DataFrame) -> DataFrame:
    """The same for templates that already carry dense ids."""
    return templates.select("template", F.col("template_id").alias("slot"), F.lit(templates.count()).alias("slots"))


def _pick(key: Column, slots: Column, seed: int, by_hash: bool) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)) if by_hash else key, slots)


def fill_templates(
    posts: DataFrame, key: str, firms: DataFrame, templates: DataFrame, seed: int = 42, by_hash: bool = True
) -> DataFrame:
    """Add ``content``: a template with every ``{}`` replaced by a firm.

    Each dictionary is looked up by slot number, so a post meets one firm and one template; no
    firm x template product is formed.
    """
    n_firms = firms.select(F.max("slots")).scalar()
    n_templates = templates.select(F.max("slots")).scalar()
    with_slots = posts.withColumns(
        {
            "firm_slot": _pick(F.col(key), n_firms, seed, by_hash),
            "template_slot": _pick(F.col(key), n_templates, seed + 1, by_hash),
        }
    )
    return (
        with_slots.join(firms.select(F.col("slot").alias("firm_slot"), "firm"), "firm_slot")
        .join(templates.select(F.col("slot").alias("template_slot"), "template"), "template_slot")
        .withColumn("content", F.expr("replace(template, '{}', firm)"))
        .drop("firm_slot", "template_slot")
    )
