"""Secret scan with corpus-wide ownership frequency, in column expressions only.

Base kinds are found by fixed patterns.  A wider pattern gives further candidates: long mixed runs that
could be credentials.  Every candidate value is hashed and counted over the whole corpus by distinct
owners and repositories.  A value that several owners hold is a copied example; one that stays with few
owners looks live, in however many repositories, and such wider candidates become spans of the kind ``owned``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.text import let
from parley.runtime import materialise

# The patterns of the base kinds, in the order of their rank.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
KINDS = ("assign", "access", "hex", "owned")

WIDER = r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{24,}+"
# Every hex match and every wider one lies in a run of this many characters that are no white space.
LONG_RUN = r"(?<!\S)\S{24}"
SPAN = "array<struct<start:int,end:int,value:string>>"


def occurrences(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost matches as ``array<struct<start, end, value>>`` in code points; ``value`` is the group's text.

    What lies between matches and the matches themselves alternate, so their lengths give the places.  They are
    summed up in chunks of the root of their number, whose sums are summed up first: no fold grows an array longer
    than that.
    """
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    none = F.array().cast(SPAN)
    width = lambda x: F.length(x.gap) + F.length(x.hit)
    end = lambda at, x: at + width(x)

    def step(acc: Column, x: Column) -> Column:
        span = F.struct((acc.at + F.length(x.gap)).alias("start"), end(acc.at, x).alias("end"), x.value.alias("value"))
        return F.struct(end(acc.at, x).alias("at"), F.concat(acc.out, F.array(span)).alias("out"))

    def from_chunks(chunks: Column) -> Column:
        total = lambda chunk: F.aggregate(chunk, F.lit(0), end)
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        add = lambda acc, n: F.struct((acc.at + n).alias("at"), F.concat(acc.out, F.array(acc.at)).alias("out"))
        bases = F.aggregate(F.transform(chunks, total), start, add, lambda acc: acc.out)
        inside = lambda both: F.aggregate(both.chunk, F.struct(both.base.alias("at"), none.alias("out")), step, lambda acc: acc.out)
        return F.flatten(F.transform(F.arrays_zip(chunks.alias("chunk"), bases.alias("base")), inside))

    def spans(found: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(found))).cast("int")
        firsts = F.sequence(F.lit(1), F.size(found), size)
        return F.when(F.size(found) > 0, let(F.transform(firsts, lambda k: F.slice(found, k, size)), from_chunks)).otherwise(none)

    return let(F.filter(parts, lambda x: x.hit.isNotNull()), spans)


def _when(test: Column, spans: Column) -> Column:
    """``spans``, worked out only where the cheap ``test`` allows for any."""
    return F.when(test, spans).otherwise(F.array().cast(SPAN))


def _tagged(spans: Column, rank: int) -> Column:
    return F.transform(
        spans, lambda x: F.struct(x.start.alias("start"), F.lit(rank).alias("rank"), x.end.alias("end"), F.sha2(x.value, 256).alias("hash"))
    )


def _named(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s.rank), s.start, s.end)), ",")


def scan(docs: DataFrame, max_owners: int = 2, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str = "doc_id") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, n_repositories`` per row.

    ``n_live`` counts spans whose value has at most ``max_owners`` owners, ``n_example`` the others; a wider
    candidate is a span only if it is live.  ``n_repositories`` is the most repositories that hold the value of
    one of the row's spans, 0 without any; it decides nothing.  Spans are ``kind:start:end`` in code points by
    start, then kind.  A null text is an empty one.  A null owner or repository counts as one more value.  Rows
    repeated under one id are scanned each.  Very long texts are scanned whole, at a cost that grows about with their
    length however many matches they hold.  Empty tables give no rows; other columns, of whatever names, are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository_col).cast("string"), F.lit("")).alias("repository"),
        _when(text.contains("=") | text.contains(":"), occurrences(text, ASSIGN, 2)).alias("assign"),
        _when(text.contains("AKIA"), occurrences(text, ACCESS)).alias("access"),
        _when(text.rlike(LONG_RUN), occurrences(text, HEX)).alias("hex"),
        _when(text.rlike(LONG_RUN), occurrences(text, WIDER)).alias("wider"),
    )
    found = found.withColumn("assign", F.filter("assign", lambda x: F.length(x.value) >= 8))
    found = materialise(found.withColumn("row", F.monotonically_increasing_id()), "secrets")

    base = F.concat(*(_tagged(F.col(kind), rank) for rank, kind in enumerate(KINDS[:3])))
    mixed = lambda x: x.value.rlike("[0-9]") & x.value.rlike("[A-Za-z]") & ~x.value.rlike("^[0-9a-f]+$")
    spans = found.select("row", "doc_id", "owner", "repository", base.alias("base"), _tagged(F.filter("wider", mixed), 3).alias("wider"))
    spans = materialise(spans, "spans")

    each = spans.select("row", "owner", "repository", F.explode(F.concat("base", "wider")).alias("span"))
    each = each.select("row", "owner", "repository", "span.*")
    # A wider candidate goes if a base span overlaps it: of those that start before its end, one ends after its start.
    base_span = F.col("rank") < 3
    along = Window.partitionBy("row").orderBy(F.when(base_span, F.col("start")).otherwise(F.col("end")), base_span)
    reach = F.max(F.when(base_span, F.col("end"))).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    each = each.withColumn("reach", F.coalesce(reach, F.lit(0))).where(base_span | (F.col("reach") <= F.col("start"))).drop("reach")
    each = materialise(each, "each")
    owners = each.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one")).groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    spread = owners.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    spread = materialise(spread, "spread")
    live = F.col("owners") <= max_owners
    judged = each.join(spread, "hash").where((F.col("rank") < 3) | live)
    judged = judged.groupBy("row").agg(
        F.count(F.when(live, 1)).alias("n_live"),
        F.count(F.when(~live, 1)).alias("n_example"),
        F.max("repositories").alias("n_repositories"),
        F.collect_list(F.when(F.col("rank") == 3, F.struct("start", "rank", "end"))).alias("owned"),
    )
    judged = materialise(judged, "judged")

    plain = F.transform("base", lambda s: F.struct(s.start.alias("start"), s.rank.alias("rank"), s.end.alias("end")))
    count = lambda rank: F.size(F.filter("base", lambda s: s.rank == rank)).cast("long")
    rows = spans.select("row", "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.array_sort(plain).alias("base"))
    rows = rows.join(judged, "row", "left")
    every = F.array_sort(F.concat("base", F.coalesce("owned", F.array().cast("array<struct<start:int,rank:int,end:int>>"))))
    return rows.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(_named(F.col("base")), 256).alias("base_sha256"), _named(every).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_example", F.lit(0)).alias("n_example"),
        F.coalesce("n_repositories", F.lit(0)).alias("n_repositories"),
    )

