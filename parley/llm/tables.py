"""Passing columns to numpy code in tasks, and groups that stream through sorted partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.runtime import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables of one run in the shared folder: written once, their shuffle files dropped with the write, removable when read."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.paths: dict[int, str] = {}

    def write(self, df: DataFrame, label: str, *done: DataFrame) -> DataFrame:
        """``df`` as a table; the tables ``done`` were read for the last time and are removed."""
        path, before = scratch_path(self.spark, label), self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = path
        self.remove(*done)
        return table

    def remove(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(table)))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def map_rows(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], Iterator[list] | list]) -> DataFrame:
    """``fn`` turns a batch into columns, or yields several column lists; ``schema`` names them."""
    names = [part.strip().split()[0] for part in schema.split(",")]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                for columns in fn(batch):
                    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, schema)


def utf8(column: str, name: str | None = None):
    """A string column as bytes, so that tasks need not decode it."""
    return F.col(column).cast("string").cast("binary").alias(name or column)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole runs of equal integer ``keys`` in a partition sorted by them.

    Gives tables that end with a run, each with the run borders ``[0, ..., rows]``.  A run may cross batches.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        edges = _borders(held[-1], keys)
        if len(edges) == 2 and (len(held) == 1 or _same(held[-2], -1, batch, 0, keys)):
            continue
        cut = int(edges[-2])
        whole = pa.Table.from_batches([*held[:-1], batch.slice(0, cut)])
        held = [batch.slice(cut)]
        if whole.num_rows:
            yield whole, _borders(whole, keys)
    if held:
        whole = pa.Table.from_batches(held)
        yield whole, _borders(whole, keys)


def _borders(rows: pa.RecordBatch | pa.Table, keys: list[str]) -> np.ndarray:
    new = np.ones(rows.num_rows, bool)
    columns = [rows.column(k).to_numpy() for k in keys]
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.append(np.flatnonzero(new), rows.num_rows)


def _same(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int, keys: list[str]) -> bool:
    return all(a.column(k)[i % a.num_rows].as_py() == b.column(k)[j].as_py() for k in keys)
