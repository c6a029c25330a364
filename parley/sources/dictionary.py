"""Entity dictionary and sentence templates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley import schemas

NAME_COLUMNS = ("name", "altname", "abbreviation", "ticker", "altticker")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row; an empty cell is NULL."""
    return spark.read.schema(schemas.DICTIONARY).csv(path, header=True, quote='"', escape='"')


def row_patterns(entries: DataFrame, columns: Sequence[str] = NAME_COLUMNS, trim: bool = True) -> DataFrame:
    """One ``pattern`` per entry: its non-empty cells joined by ``|``; distinct, non-empty."""
    cells = [F.trim(F.col(c)) if trim else F.col(c) for c in columns]
    joined = F.concat_ws("|", *[F.nullif(cell, F.lit("")) for cell in cells])
    return entries.select(joined.alias("pattern")).where(F.length("pattern") > 0).distinct()


def terms(patterns: DataFrame) -> DataFrame:
    """One ``term`` per alternative of every pattern, distinct."""
    return patterns.select(F.explode(F.split("pattern", "[|]")).alias("term")).distinct()


def bounded_patterns(patterns: DataFrame) -> DataFrame:
    """Every alternative wrapped in word boundaries, as ``bounded``."""
    wrapped = F.transform(F.split("pattern", "[|]"), lambda t: F.concat(F.lit(r"\b"), t, F.lit(r"\b")))
    return patterns.withColumn("bounded", F.array_join(wrapped, "|"))


def term_owners(
    entries: DataFrame, columns: Sequence[str] = NAME_COLUMNS, owner: str = "name"
) -> DataFrame:
    """``(term, owner)`` pairs; a ticker shared by two entries gives two rows."""
    cells = F.array_compact(F.array(*[F.nullif(F.trim(F.col(c)), F.lit("")) for c in columns]))
    return entries.select(
        F.explode(F.transform(cells, lambda c: F.lower(c))).alias("term"), F.trim(owner).alias("owner")
    ).distinct()


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV; every non-blank cell of every row is a ``template``; the widest line sets the number of cells."""
    commas = F.size(F.split("value", ","))
    cells = spark.read.text(path).agg(F.max(commas)).first()[0] or 1
    wide = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(cells)])
    cells = spark.read.schema(wide).csv(path, header=False, quote='"', escape='"')
    template = F.explode(F.transform(F.array(*cells.columns), lambda c: F.trim(c)))
    return cells.select(template.alias("template")).where(F.length("template") > 0)
