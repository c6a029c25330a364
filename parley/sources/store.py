"""Keyed Parquet tables with idempotent appends, and the run marks kept beside them."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley import schemas
from parley.operators.keys import first_seen, not_stored
from parley.operators.recency import moment
from parley.runtime import materialise
from parley.sources import keyfilter

# Default start when no run has been recorded.
DEFAULT_START = dt.timedelta(days=1)


class Store:
    """Tables below one shared folder.

    ``comments`` and ``sentiment`` are partitioned by the day of the comment, so a look-back reads only
    its days.  The key constraint is kept by ``append_new``: first-wins inside the batch, then an anti
    join with the days whose key filters let a key of the batch through, whatever day it now comes under.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create(self, name: str, schema: T.StructType, partition_by: str | None = None) -> None:
        """Create an empty table unless it is there."""
        writer = self.spark.createDataFrame([], schema).write.mode("ignore")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(self._path(name))

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        """The columns of ``schema``; a partition column it does not name is left out."""
        return self.spark.read.schema(schema).parquet(self._path(name)).select(schema.names)

    def append(self, name: str, rows: DataFrame, schema: T.StructType, partition_by: str | None = None) -> None:
        """Append by column name (case-insensitive); an empty frame adds nothing."""
        writer = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.mode("append")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(self._path(name))

    def append_new(
        self, name: str, rows: DataFrame, key: str, schema: T.StructType, partition_by: str | None = None, time: str | None = None
    ) -> None:
        """Append the rows whose ``key`` is not stored yet; replaying a batch adds nothing.

        The batch is met twice (which keys collide, which rows stay), so it is written down first.  Of
        copies in a batch the earliest by ``time`` stays; ties go by a hash of the whole row, so the
        choice does not depend on the order of the input.  Of a partitioned table only those partitions
        are read whose key filters may hold a key of the batch.  New filters are written before the rows:
        a run lost in between leaves a filter that lets too much through, never one that hides a key.
        """
        whole = F.xxhash64(*[c for c in rows.columns])
        once = materialise(first_seen(rows, [key], [*([time] if time else []), whole]), f"{name}-batch")
        stored = self.read(name, schema)
        if not partition_by:
            self.append(name, not_stored(once, stored, key), schema)
            return
        parts = keyfilter.parts_that_may_hold(self.key_filters(name, key, schema, partition_by), once, key)
        new = materialise(not_stored(once, in_parts(stored, partition_by, parts), key), f"{name}-new")
        self._write_filters(name, keyfilter.build(new, key, partition_by), "append")
        self.append(name, new, schema, partition_by)

    def key_filters(self, name: str, key: str, schema: T.StructType, partition_by: str) -> DataFrame:
        """The key filters of a partitioned table, made from its rows if none have been written yet."""
        shape = keyfilter.schema(schema[partition_by].dataType)
        try:
            filters = self.read(f"{name}-keys", shape)
            if filters.inputFiles():
                return filters
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
        self._write_filters(name, keyfilter.build(self.read(name, schema), key, partition_by), "overwrite")
        return self.read(f"{name}-keys", shape)

    def _write_filters(self, name: str, filters: DataFrame, mode: str) -> None:
        filters.write.mode(mode).parquet(self._path(f"{name}-keys"))

    # -- the three tables of the pipeline ------------------------------------------------------

    COMMENTS_STORED = T.StructType(schemas.COMMENTS.fields + [T.StructField("day", T.DateType())])
    SENTIMENT_STORED = T.StructType(schemas.SENTIMENT.fields + [T.StructField("day", T.DateType())])

    def create_tables(self) -> None:
        self.create("comments", self.COMMENTS_STORED, "day")
        self.create("sentiment", self.SENTIMENT_STORED, "day")
        self.create("topic_summaries", schemas.TOPIC_SUMMARIES)

    def comments(self) -> DataFrame:
        return self.read("comments", self.COMMENTS_STORED)

    def insert_new_comments(self, rows: DataFrame) -> None:
        dated = rows.withColumn("day", F.to_date("comment_date"))
        self.append_new("comments", dated, "comment_id", self.COMMENTS_STORED, "day", "comment_date")

    def update_sentiment(self, rows: DataFrame) -> None:
        """``rows`` may carry the ``day`` of their comment; without it they go under no day."""
        dated = rows if "day" in rows.columns else rows.withColumn("day", F.lit(None).cast("date"))
        self.append_new("sentiment", dated, "comment_id", self.SENTIMENT_STORED, "day")

    def update_topic_summaries(self, rows: DataFrame) -> None:
        self.append("topic_summaries", rows, schemas.TOPIC_SUMMARIES)

    def existing_ids(self, name: str) -> DataFrame:
        schema = self.COMMENTS_STORED if name == "comments" else self.SENTIMENT_STORED
        return self.read(name, schema).select("comment_id")

    def recent_comments(self, run_ts: dt.datetime, n_days: int = 7) -> DataFrame:
        """Comments dated ``run_ts - n_days`` or later; whole days are pruned by the partition column."""
        since = run_ts - dt.timedelta(days=n_days)
        kept = (F.col("day") >= F.lit(since.date())) & (F.col("comment_date") >= moment(since))
        return self.comments().where(kept).drop("day")

    # -- run state -----------------------------------------------------------------------------

    def last_run(self, pipeline: str, run_ts: dt.datetime) -> dt.datetime:
        """The recorded high-water mark, or one day before ``run_ts`` when there is none."""
        self.create("last_run", schemas.LAST_RUN)
        marks = self.read("last_run", schemas.LAST_RUN).where(F.col("pipeline") == pipeline)
        newest = marks.agg(F.date_format(F.max("last_run"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
        return dt.datetime.fromisoformat(newest) if newest else run_ts - DEFAULT_START

    def record_run(self, pipeline: str, last_run: dt.datetime) -> None:
        """Marks are appended and the newest counts, so a lost write never loses the old mark."""
        row = self.spark.range(1).select(F.lit(pipeline).alias("pipeline"), moment(last_run).alias("last_run"))
        self.append("last_run", row, schemas.LAST_RUN)


def in_parts(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows of the partitions ``values``, where None stands for the one without a value."""
    given = [v for v in values if v is not None]
    kept = F.col(column).isin(given) if given else F.lit(False)
    return df.where(kept | F.col(column).isNull() if None in values else kept)


def latest_date(df: DataFrame, column: str = "date") -> dt.date | None:
    """Newest date of a table; None when it is empty."""
    return df.agg(F.max(F.to_date(column))).first()[0]


def due_today(summaries: DataFrame, run_date: dt.date) -> bool:
    """True unless ``run_date`` already has summaries."""
    return summaries.where(F.to_date("date") == F.lit(run_date)).isEmpty()
