"""Time filters, rolling look-backs, run counters and time formats.

Every cut-off is a parameter.  Bounds are typed like the column they meet, so they reach the
Parquet scan as pushed filters.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.patterns import alternation

# Formats of stored and exchanged time stamps.
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def moment(at: dt.datetime, kind: T.DataType | str = "timestamp") -> Column:
    """A clock time as a literal, read in the session time zone."""
    return F.lit(str(at)).cast(kind)


def _bound(df: DataFrame, column: str, at: dt.datetime) -> Column:
    return moment(at, df.schema[column].dataType)


def newer_than(df: DataFrame, column: str, last_run: dt.datetime) -> DataFrame:
    """Strictly after the high-water mark."""
    return df.where(F.col(column) > _bound(df, column, last_run))


def not_older(df: DataFrame, column: str, run_ts: dt.datetime, age: dt.timedelta) -> DataFrame:
    """At ``run_ts - age`` or later."""
    return df.where(F.col(column) >= _bound(df, column, run_ts - age))


def rolling_days(df: DataFrame, column: str, keys: Sequence[str], n_days: int, **measures: tuple[str, str]) -> DataFrame:
    """Per run date: sums and counts over that day and the ``n_days - 1`` before it.

    Rows are first reduced to one per day and key; only those are spread over the days they count
    for, so the raw rows are never multiplied by the window length.
    """
    aggregate = {"count": F.count, "sum": F.sum}
    day = F.to_date(column)
    daily = df.groupBy(day.alias("day"), *keys).agg(
        *[aggregate[kind](value).alias(name) for name, (kind, value) in measures.items()]
    )
    spread = daily.withColumn("run_date", F.explode(F.transform(F.sequence(F.lit(0), F.lit(n_days - 1)), lambda k: F.date_add("day", k))))
    return spread.groupBy("run_date", *keys).agg(*[F.sum(name).alias(name) for name in measures])


def counters(df: DataFrame, text: str, terms: Sequence[str]) -> DataFrame:
    """Rows checked, rows that mention a term, characters read; one pass."""
    return df.agg(
        F.count("*").alias("rows_checked"),
        F.count_if(F.col(text).rlike(alternation(terms))).alias("rows_collected"),
        F.sum(F.length(text)).alias("chars"),
    )


def observed(df: DataFrame, name: str, matched: Column):
    """The same counters collected while another job runs; returns ``(df, observation)``."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("checked"), F.count_if(matched).alias("collected")), seen


def stamp(at: Column) -> Column:
    return F.date_format(at, STAMP_FORMAT)


def iso(at: Column) -> Column:
    return F.date_format(at, ISO_FORMAT)


def parse_stamp(text: Column) -> Column:
    return F.to_timestamp_ntz(F.trim(text), F.lit(STAMP_FORMAT))


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds to a timestamp in the session time zone."""
    return F.timestamp_seconds(seconds)


def epoch_of(at: Column) -> Column:
    """Epoch seconds of a clock time without a zone, taken as UTC."""
    seconds = F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
    return F.unix_date(F.to_date(at)).cast("bigint") * 86_400 + seconds


def days_before(at: Column, n: int) -> Column:
    return at - F.make_interval(days=F.lit(n))
