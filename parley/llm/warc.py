"""A content-addressed WARC archive.

``payloads`` holds every distinct payload once, under its SHA-256; ``records`` holds the exact header
bytes of every record and the digest of its payload.  A record is rebuilt by joining the two, and
reading verifies both digests and the length that the header states.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm.tables import map_rows
from parley.runtime import materialise

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "urn:page:"


def _headers(page_id, url, length, sha1, refers):
    """The header block of a record, with the empty line that ends it."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
    revisit = F.concat(
        F.lit(f"WARC-Type: revisit\r\nWARC-Profile: {PROFILE}\r\n"), line("WARC-Refers-To", F.concat(F.lit(f"<{RECORD}"), refers.cast("string"), F.lit(">")))
    )
    flat = F.regexp_replace(F.coalesce(url, F.lit("")), "[\r\n]", " ")
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        F.when(refers.isNull(), F.lit("WARC-Type: response\r\n")).otherwise(revisit),
        line("WARC-Record-ID", F.concat(F.lit(f"<{RECORD}"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", flat),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1)),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", length),
        F.lit("\r\n"),
    ).cast("binary")


def write_archive(pages: DataFrame, path: str, least_revisit: int = 1000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write ``records`` and ``payloads`` below ``path``.

    Of records with equal payloads of at least ``least_revisit`` bytes the one with the largest id is the
    response and the others revisit it; repeated rows of that id are responses too, and without any id all
    are responses.  A null html is an empty payload, a null url an empty one.  Payloads are summed by
    digest before the shuffle, so a group of copies sends one payload per task.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("payload"))
    keys = rows.select(
        "page_id", "url", F.octet_length("payload").alias("length"), F.sha1("payload").alias("sha1"), F.unhex(F.sha2("payload", 256)).alias("digest")
    )
    holders = keys.where((F.col("length") >= least_revisit) & F.col("page_id").isNotNull())
    holders = holders.groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("holder")).where("n > 1")
    holders = materialise(holders.select("digest", "holder"), "holders")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("holder")), F.lit(None)).otherwise(F.col("holder"))
    records = keys.join(holders, "digest", "left").select(
        "digest", _headers(F.col("page_id"), F.col("url"), F.col("length"), F.col("sha1"), refers).alias("header")
    )
    records.write.parquet(f"{path}/records", compression="zstd")
    payloads = rows.select(F.unhex(F.sha2("payload", 256)).alias("digest"), "payload").groupBy("digest").agg(F.first("payload").alias("payload"))
    payloads.write.parquet(f"{path}/payloads", compression="zstd")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``header, payload, page_id, payload_bytes, payload_digest, record_type, refers_to``: every record, rebuilt and verified."""
    records = spark.read.schema("digest binary, header binary").parquet(f"{path}/records")
    payloads = spark.read.schema("digest binary, payload binary").parquet(f"{path}/payloads")

    def rebuild(batch):
        out: list[list] = [[], [], [], [], []]
        for key, header, payload in zip(*(batch.column(c).to_pylist() for c in ("digest", "header", "payload"))):
            if hashlib.sha256(payload).digest() != key:
                raise ValueError("a payload does not have the digest it is stored under")
            fields = dict(line.split(": ", 1) for line in header.decode().split("\r\n")[1:-2])
            sha1 = hashlib.sha1(payload).hexdigest()
            if fields["WARC-Payload-Digest"] != f"sha1:{sha1}" or int(fields["Content-Length"]) != len(payload):
                raise ValueError(f"record {fields['WARC-Record-ID']} does not match its payload")
            number = lambda name: int(fields[name][len(RECORD) + 1 : -1]) if len(fields.get(name, "")) > len(RECORD) + 2 else None
            for column, value in zip(out, (number("WARC-Record-ID"), len(payload), sha1, fields["WARC-Type"], number("WARC-Refers-To"))):
                column.append(value)
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        yield [batch.column("header"), batch.column("payload"), *(pa.array(c, t) for c, t in zip(out, types))]

    schema = "header binary, payload binary, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return map_rows(records.join(payloads, "digest"), schema, rebuild)
