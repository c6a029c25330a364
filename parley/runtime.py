"""Session set-up and the shared scratch folder.

Everything that has to outlive one query plan (an iteration's state, a table that several branches
read) is written as Parquet below the folder named by ``spark.checkpoint.dir``.  The planner then
knows its size, so the ordinary broadcast threshold decides how it is joined, and a lost executor
only costs a re-read.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(app: str = "parley", **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for (adaptive, UTC, no web page)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only for a local master."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder
    if context.master.startswith("local-cluster") or not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="parley-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "table", compression: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and gives the planner its true size."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# A table of up to this many rows may be sent to every executor.
BROADCAST_ROWS = 500_000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``rows`` rows, else leave the join to the planner.

    The planner sizes a side by its input files, so it takes exploded text for smaller than it is;
    this keeps the text on the streamed side.  Meant for dictionaries and materialised tables, where
    counting is cheap.
    """
    return F.broadcast(df) if df.count() <= rows else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Redistribute an input that has fewer splits than there are cores, e.g. one small file.

    A large input has more splits than cores and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
