"""Near-duplicate documents by HyperMinHash registers, banded, estimated, and confirmed on full shingle sets.

1. Every text becomes its set of word shingles.  Texts with equal sets form a class; from here on a
   class counts once, so a group of exact copies of any size costs one row.
2. A class keeps ``bands * rows`` HyperMinHash registers: of the smallest hash in each bucket of the
   set, the number of leading zeros and ten bits of mantissa.  Empty registers are filled from the
   next one for banding only.
3. Classes that share a band meet.  In a shared bucket every class is compared with the bucket's
   first class by the registers' Jaccard estimate, corrected for chance agreement.  Buckets that
   still hold several families are compared in blocks of bounded size, only across families.
4. Families are the connected classes of step 3.  Inside a family all pairs are decided on full sets:
   in one block if it is small, else first against its smallest class and then block by block
   among the classes that comparison left apart.  Only links come out of a task, at most one per row,
   laid as stars.

Two texts of the wanted likeness miss all of 48 bands of 5 registers with a chance below 1e-8.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm import wordhash
from parley.llm.graph import components
from parley.llm.tables import grouped, map_rows, utf8
from parley.runtime import materialise

MANTISSA = 10
EMPTY = np.uint16(65535)
# A block of an estimate holds about this many classes, a block of sets about this many shingles.
BLOCK_CLASSES = 512
BLOCK_SHINGLES = 1 << 17


@dataclass(frozen=True)
class Likeness:
    """``percent``: least Jaccard likeness in hundredths of sets of ``words``-word shingles."""

    words: int = 5
    percent: int = 80
    rows: int = 5
    bands: int = 48

    @property
    def registers(self) -> int:
        return self.rows * self.bands

    @property
    def least_estimate(self) -> float:
        """Five standard errors below the wanted likeness."""
        t = self.percent / 100
        return t - 5 * (t * (1 - t) / self.registers) ** 0.5


def registers(sets: list[np.ndarray], count: int) -> np.ndarray:
    """HyperMinHash registers of sets of 64-bit hashes, one row of ``count`` each; ``EMPTY`` where no hash fell."""
    least = np.full(len(sets) * count, 2**64 - 1, np.uint64)
    if sets:
        values = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        bucket = ((values >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(least, row * count + bucket, wordhash.mix(values ^ np.uint64(0x5BD1E995)))
    fraction, exponent = np.frexp(least.astype(np.float64))
    zeros = np.clip(64 - exponent, 0, 62).astype(np.uint16)
    out = (zeros << np.uint16(MANTISSA)) | ((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.uint16)
    out[least == np.uint64(2**64 - 1)] = EMPTY
    return out.reshape(len(sets), count)


def filled(regs: np.ndarray) -> np.ndarray:
    """Empty registers take the value of the next register that has one, round the end."""
    count = regs.shape[1]
    place = np.where(regs == EMPTY, 4 * count, np.arange(count))
    around = np.concatenate([place, place + count], axis=1)
    following = np.minimum.accumulate(around[:, ::-1], axis=1)[:, ::-1][:, :count] % count
    return np.take_along_axis(regs, following, axis=1)


def band_keys(regs: np.ndarray, like: Likeness) -> np.ndarray:
    """One 64-bit key per row and band."""
    parts = filled(regs).reshape(len(regs), like.bands, like.rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(like.bands, dtype=np.uint64), parts.shape[:2])
    for j in range(like.rows):
        key = wordhash.mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return key


def marks(regs: np.ndarray) -> np.ndarray:
    """Registers as one byte each: 0 for an empty one, else one of 255 values."""
    out = (wordhash.mix(regs.astype(np.uint64)) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    out[regs == EMPTY] = 0
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimate from marks, without the agreement that chance gives among 255 values."""
    used = np.count_nonzero(a | b, axis=-1)
    both = np.count_nonzero((a != 0) & (b != 0), axis=-1)
    same = np.count_nonzero(a == b, axis=-1) - (a.shape[-1] - used)
    by_chance = (both - same) / 254
    return np.where(used > 0, (same - by_chance) / np.maximum(used, 1), 0.0)


class Forest:
    """A union-find over ``n`` places."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)

    def stars(self) -> list[tuple[int, int]]:
        """Every place but the first of its tree, with that first place."""
        return [(x, self.find(x)) for x in range(len(self.parent)) if self.find(x) != x]


def _binary_rows(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _signatures(docs: DataFrame, like: Likeness) -> DataFrame:
    """One row per document: set size, a 128-bit key of the set and its registers (null for an empty set)."""

    def sign(batch):
        texts = batch.column("text").to_pylist()
        for block in wordhash.blocks(texts):
            sets = list(wordhash.shingles(block, like.words))
            regs = registers(sets, like.registers)
            yield [
                batch.column("doc_id").slice(block.begin, len(sets)),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([r.tobytes() if len(s) else None for s, r in zip(sets, regs)], pa.binary()),
            ]

    return map_rows(docs, "doc_id long, n long, set_key binary, regs binary", sign)


def _bands(classes: DataFrame, like: Likeness) -> DataFrame:
    def cut(batch):
        regs = np.frombuffer(b"".join(batch.column("regs").to_pylist()), np.uint16).reshape(-1, like.registers)
        keys = band_keys(regs, like).view(np.int64).ravel()
        repeat = lambda name: np.repeat(batch.column(name).to_numpy(), like.bands)
        yield [keys, repeat("cls"), repeat("n")]

    return map_rows(classes.select("cls", "n", "regs"), "key long, cls long, n long", cut)


def _ratio(a: str, b: str, like: Likeness):
    """No pair of sets whose sizes differ more than this can be alike."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * like.percent


def _star_edges(shared: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """Pairs of a class and the first class of one of its buckets whose estimate is high enough."""
    pairs = shared.where("cls <> rep").where(_ratio("n", "rep_n", like)).select("cls", "rep").distinct()
    sides = classes.select("cls", "marks")
    pairs = materialise(pairs, "stars").join(sides, "cls").join(
        sides.select(F.col("cls").alias("rep"), F.col("marks").alias("rep_marks")), "rep"
    )

    def compare(batch):
        read = lambda name: np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint8).reshape(-1, like.registers)
        keep = pa.array(estimate(read("marks"), read("rep_marks")) >= like.least_estimate)
        yield [batch.column("cls").filter(keep), batch.column("rep").filter(keep)]

    return map_rows(pairs, "a long, b long", compare)


def _block_pairs(members: DataFrame, keys: list[str], blocks: str, ident: str) -> DataFrame:
    """Deal the members of a group to blocks and every block to the pairs ``(i, j)``, ``i <= j``, it is part of."""
    own = F.pmod(F.xxhash64(ident), F.col(blocks)).cast("int")
    dealt = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    return dealt.repartition(*keys, "i", "j").sortWithinPartitions(*keys, "i", "j")


def _rough_families(edges: DataFrame) -> DataFrame:
    """``(node, root)``: the smallest node within two steps; it only spares comparisons, so it need not be the whole family.

    The first step is read from a table, so a join with it can be split at a hub.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    first = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    first = materialise(first, "lowest")
    second = both.join(first.select(F.col("a").alias("b"), "m"), "b").groupBy("a").agg(F.min("m").alias("far"))
    return second.join(first, "a").select(F.col("a").alias("node"), F.least("m", "far").alias("root"))


def _similar(n: np.ndarray, fam: np.ndarray, own: np.ndarray, seen: np.ndarray, one: bool, like: Likeness) -> list[tuple[int, int]]:
    """Stars over the pairs of a block whose estimate is high enough and whose families differ."""
    forest = Forest(len(n))
    step = max(1, (1 << 14) // len(n))
    for begin in range(0, len(n), step):
        # A chunk of rows against all later rows; only the pairs that can be alike reach the estimate.
        x, y = np.divmod(np.arange(begin * len(n), min(begin + step, len(n)) * len(n)), len(n))
        may = (x < y) & (fam[x] != fam[y]) & (np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * like.percent)
        may &= one | (own[x] != own[y])
        x, y = x[may], y[may]
        if len(x):
            hit = estimate(seen[x], seen[y]) >= like.least_estimate
            for i, j in zip(x[hit].tolist(), y[hit].tolist()):
                forest.join(i, j)
    return forest.stars()


def _across_families(shared: DataFrame, family: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """Edges between families that share a bucket: blocks of a bucket's classes, compared by their marks."""
    members = shared.select("key", "cls", "n").join(family, F.col("cls") == F.col("node"), "left")
    members = members.select("key", "cls", "n", F.coalesce("root", "cls").alias("fam"))
    mixed = members.groupBy("key").agg(F.min("fam").alias("lo"), F.max("fam").alias("hi"), F.count("*").alias("size"))
    mixed = materialise(
        mixed.where("lo <> hi").select("key", F.ceil(F.col("size") / BLOCK_CLASSES).alias("nb")), "mixed"
    )
    members = members.join(mixed, "key").join(classes.select("cls", "marks"), "cls")
    dealt = _block_pairs(members, ["key"], "nb", "cls")

    def compare(batches):
        for table, borders in grouped(batches, ["key", "i", "j"]):
            cls, n, fam, own = (table.column(c).to_numpy() for c in ("cls", "n", "fam", "own"))
            one = table.column("i").to_numpy() == table.column("j").to_numpy()
            seen = np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint8).reshape(-1, like.registers)
            a_out, b_out = [], []
            for begin, end in zip(borders[:-1], borders[1:]):
                pairs = _similar(n[begin:end], fam[begin:end], own[begin:end], seen[begin:end], one[begin], like)
                a_out += [cls[begin + x] for x, _ in pairs]
                b_out += [cls[begin + y] for _, y in pairs]
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])

    return dealt.select("key", "cls", "n", "fam", "own", "i", "j", "marks").mapInArrow(compare, "a long, b long")


def linked(sets: list[np.ndarray], percent: int, wanted=None) -> list[tuple[int, int]]:
    """Stars over the pairs of ``sets`` with ``100 * intersection >= percent * union``.

    ``wanted(x)`` gives a mask of the places to compare with ``x``; places before ``x`` are left out.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    _, place = np.unique(np.concatenate(sets), return_inverse=True)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    mark = np.zeros(place.max() + 1, np.int64)
    forest = Forest(len(sets))
    for x in range(len(sets) - 1):
        rest = np.arange(x + 1, len(sets))
        fits = np.minimum(sizes[rest], sizes[x]) * 100 >= np.maximum(sizes[rest], sizes[x]) * percent
        rest = rest[fits if wanted is None else fits & wanted(x)[rest]]
        if not len(rest):
            continue
        own = place[begin[x] : begin[x + 1]]
        mark[own] = 1
        common = np.add.reduceat(mark[place], begin[:-1])[rest]
        mark[own] = 0
        for y in rest[common * 100 >= (sizes[rest] + sizes[x] - common) * percent].tolist():
            forest.join(x, y)
    return forest.stars()


def _keyed(batch, like: Likeness):
    for block in wordhash.blocks(batch.column("text").to_pylist()):
        keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in wordhash.shingles(block, like.words)]
        yield [pa.array(keys, pa.binary()), batch.column("text").slice(block.begin, len(keys))]


def _confirmed(docs: DataFrame, classes: DataFrame, family: DataFrame, like: Likeness) -> DataFrame:
    """Links ``(a, b)`` between classes of one family, decided on full sets."""
    wanted = family.join(classes.select(F.col("cls").alias("node"), "doc_id", "set_key"), "node")

    def build(batch):
        for block in wordhash.blocks(batch.column("text").to_pylist()):
            sets = list(wordhash.shingles(block, like.words))
            rows = batch.slice(block.begin, len(sets))
            keys = rows.column("set_key").to_pylist()
            keep = pa.array([len(s) > 0 and xxhash.xxh3_128_digest(s.tobytes()) == k for s, k in zip(sets, keys)])
            yield [
                *(rows.column(c).filter(keep) for c in ("root", "node")),
                pa.array([len(s) for s in sets], pa.int64()).filter(keep),
                pa.array([s.tobytes() for s in sets], pa.binary()).filter(keep),
            ]

    chosen = docs.join(wanted.where("doc_id is not null").withColumnRenamed("doc_id", "wanted_id"), F.col("doc_id") == F.col("wanted_id"))
    chosen = chosen.select("root", "node", "set_key", "text")
    if not classes.where("doc_id is null").isEmpty():
        nameless = wanted.where("doc_id is null").select("root", "node", F.col("set_key").alias("wanted_key"))
        # Classes whose texts all lack an id are met by their set; one text of each is enough.
        keyed = map_rows(docs.where("doc_id is null"), "set_key binary, text binary", lambda batch: _keyed(batch, like))
        one = keyed.groupBy("set_key").agg(F.first("text").alias("text"))
        met = one.join(nameless, F.col("set_key") == F.col("wanted_key"))
        chosen = chosen.unionByName(met.select("root", "node", "set_key", "text"))
    sets = map_rows(chosen, "fam long, cls long, n long, hashes binary", build)
    sets = materialise(sets, "sets")
    sizes = sets.groupBy("fam").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("nb"), F.min("cls").alias("pivot"))
    sizes = materialise(sizes, "families")
    none_large = sizes.where("nb > 1").isEmpty()
    read = lambda column: [np.frombuffer(b, np.uint64) for b in column.to_pylist()]

    small = sets.join(sizes.where("nb <= 1").select("fam"), "fam")
    small = small.select("fam", "cls", F.lit(False).alias("near"), F.lit(0).alias("own"), F.lit(0).alias("i"), F.lit(0).alias("j"), "hashes")
    small = small.repartition("fam").sortWithinPartitions("fam", "i", "j")

    def decide(batches):
        for table, borders in grouped(batches, ["fam", "i", "j"]):
            cls, near, own = (table.column(c).to_numpy(zero_copy_only=False) for c in ("cls", "near", "own"))
            one = table.column("i").to_numpy() == table.column("j").to_numpy()
            pairs = []
            for begin, end in zip(borders[:-1], borders[1:]):
                part = slice(begin, end)
                if not near[part].all():
                    wanted = lambda x: ~(near[part] & near[part][x]) & ((own[part] != own[part][x]) | one[begin])
                    found = linked(read(table.column("hashes").slice(begin, end - begin)), like.percent, wanted)
                    pairs += [(begin + x, begin + y) for x, y in found]
            a, b = (pa.array([cls[p[k]] for p in pairs], pa.int64()) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    links = small.mapInArrow(decide, "a long, b long")
    if none_large:
        return links
    # Large families: what the pivot links needs no comparison among itself.
    large = sets.join(sizes.where("nb > 1"), "fam")
    pivots = sets.join(sizes.where("nb > 1").select(F.col("pivot").alias("cls")), "cls").select("fam", F.col("hashes").alias("pivot_hashes"))
    pivots = materialise(pivots.dropDuplicates(["fam"]), "pivots")

    def against(batch):
        keep = []
        for a, b in zip(read(batch.column("hashes")), read(batch.column("pivot_hashes"))):
            common = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(common * 100 >= (len(a) + len(b) - common) * like.percent)
        yield [*(batch.column(c) for c in ("fam", "cls", "pivot", "nb")), pa.array(keep, pa.bool_()), batch.column("hashes")]

    tried = large.select("fam", "cls", "pivot", "nb", "hashes").join(pivots, "fam")
    tried = map_rows(tried, "fam long, cls long, pivot long, nb long, near boolean, hashes binary", against)
    tried = materialise(tried, "tried")
    apart = materialise(tried.where("not near").select("fam").distinct(), "apart")
    dealt = _block_pairs(tried.join(apart, "fam", "left_semi"), ["fam"], "nb", "cls")
    dealt = dealt.select("fam", "cls", "near", "own", "i", "j", "hashes")

    links = links.unionByName(dealt.mapInArrow(decide, "a long, b long"))
    return links.unionByName(tried.where("near and cls <> pivot").select(F.col("cls").alias("a"), F.col("pivot").alias("b")))


def near_duplicates(docs: DataFrame, like: Likeness = Likeness(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id among all texts reachable over links, the row itself included;
    ``kept`` says it is the row's own id.  A null or wordless text has no shingles and no links.  A row
    without an id links others but is never a component's name: its ``component_id`` is the smallest id
    of its group, null if the group has none, and ``kept`` is true only in that last case.  Rows repeated
    under one id get the same answer each.  Other columns of ``docs`` are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col, "text"))
    signed = materialise(_signatures(docs, like), "signatures")
    classes = signed.where("n > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("regs").alias("regs")
    )

    def add_marks(batch):
        regs = np.frombuffer(b"".join(batch.column("regs").to_pylist()), np.uint16).reshape(-1, like.registers)
        yield [*(batch.column(c) for c in ("set_key", "doc_id", "n", "regs")), _binary_rows(marks(regs))]

    classes = map_rows(classes, "set_key binary, doc_id long, n long, regs binary, marks binary", add_marks)
    classes = materialise(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")

    bands = _bands(classes, like)
    buckets = bands.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct("cls", "n")).alias("first"))
    buckets = materialise(buckets.where("size > 1").select("key", F.col("first.cls").alias("rep"), F.col("first.n").alias("rep_n")), "buckets")
    shared = materialise(bands.join(buckets, "key"), "shared")

    stars = materialise(_star_edges(shared, classes, like), "edges")
    family = materialise(_rough_families(stars), "family")
    across = materialise(_across_families(shared, family, classes, like), "edges")
    family = materialise(components(stars.unionByName(across)), "family")
    links = materialise(_confirmed(docs, classes, family, like), "links")
    group = materialise(components(links), "group")

    named = classes.join(group, F.col("cls") == F.col("node"), "left")
    named = materialise(named.select("set_key", "doc_id", F.coalesce("root", "cls").alias("root")), "named")
    names = materialise(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "names")
    named = materialise(named.join(names, "root").select("set_key", "component_id"), "named")
    out = signed.select("doc_id", "n", "set_key").join(named, "set_key", "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("doc_id").isNull() & F.col("component_id").isNull())
    )
