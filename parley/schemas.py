"""Table schemas and the conform step that repairs missing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


TEXT, NUMBER, TIME = T.StringType(), T.LongType(), T.TimestampType()


def _fields(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


DICTIONARY = _fields(name=TEXT, altname=TEXT, abbreviation=TEXT, ticker=TEXT, altticker=TEXT, notes=TEXT)
COMMENTS = _fields(
    comment_id=TEXT, post_title=TEXT, subreddit=TEXT, comment_date=TIME, comment=TEXT,
    matched_phrase=TEXT, upvotes=NUMBER,
)
SENTIMENT = _fields(comment_id=TEXT, compound=T.DoubleType(), sentiment=TEXT)
TOPIC_SUMMARIES = _fields(
    date=T.DateType(), topic=T.IntegerType(), summary=TEXT, keybert=TEXT, mmr=TEXT, size=NUMBER
)
POSTS = _fields(
    subreddit=TEXT, post_id=TEXT, title=TEXT, created_utc=NUMBER,
    comments=T.ArrayType(_fields(id=TEXT, body=TEXT, created_utc=NUMBER, score=NUMBER)),
)
GENERATED_POSTS = _fields(timestamp=TIME, tweet_content=TEXT)
LAST_RUN = _fields(pipeline=TEXT, last_run=TIME)


def conform(df: DataFrame, schema: T.StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """Add the columns of ``schema`` that ``df`` lacks; text defaults to '', numbers to 0.

    Names are compared without case.  Columns outside the schema are kept.
    """
    present = {c.lower() for c in df.columns}
    missing = {}
    for field in schema:
        if field.name.lower() in present:
            continue
        if defaults and field.name in defaults:
            value = defaults[field.name]
        elif isinstance(field.dataType, T.StringType):
            value = ""
        elif isinstance(field.dataType, T.NumericType):
            value = 0
        else:
            value = None
        missing[field.name] = F.lit(value).cast(field.dataType)
    return df.withColumns(missing) if missing else df


def clean_comments(df: DataFrame) -> DataFrame:
    """Take ``+`` and leftover pattern escapes out of the matched phrase, then conform."""
    if "matched_phrase" in {c.lower() for c in df.columns}:
        df = df.withColumn("matched_phrase", F.regexp_replace("matched_phrase", r"\\b|\\s|\+", ""))
    return conform(df, COMMENTS)
