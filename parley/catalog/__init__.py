"""Every operator as a named query over the given tables, with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parley.runtime import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; ``sql`` is the equivalent over the same tables."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str = "documents", key: str = "doc_id") -> DataFrame:
    """A table whose rows are costly to read; a single small file is spread over the cores."""
    return spread(table(spark, sf_dir, name), key)


def load() -> None:
    """Import every module that registers queries."""
    from parley.catalog import (  # noqa: F401
        evaluate,
        incremental,
        mentions,
        pipeline,
        sentiment,
        summaries,
        terms,
        vectors,
    )
