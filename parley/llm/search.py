"""Ranked lexical search: exact inner products, by sparse ball trees with safe bounds.

A document is a sparse vector over the query terms (component of a term: ``1000000000 * tf div (1000 * tf + 8 * m)``), an item the
vector of its terms' weights; the score is their inner product.  One pass over the texts keeps the query terms of every document
with their counts; the tasks of a second pass cut their vectors into trees and search each tree for every item.

A tree node has the centroid of its documents, the radius of the ball round it, and the largest component per term.  No document
below it scores above ``<q, centroid> + |q| * radius``, nor above ``<q, largest>`` (ball and rectangle together, as in the
SR-tree of Katayama and Satoh 1997).  Bounds are floating point, raised by more than their rounding error, so pruning is safe.
A node is opened best bound first and only while its bound reaches the item's lowest kept score; leaves are scored in 64-bit
integers.  A task keeps the best of all its trees per item, and its best of the trees so far prune the next; the tasks'
answers, ``top`` rows an item and task, are ranked in the end.

Bounded: items are dealt into buckets of about ``bucket_terms`` terms, for each of which the texts are read once and whose terms are
broadcast; inside it blocks of at most ``block_items`` items and ``block_terms`` terms (or one item) are searched, and a tree takes as many documents
as fit ``cells`` numbers.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.tables import Scratch, map_rows

# Everything but ASCII other than digits and letters, in UTF-8 with A-Z lower-cased.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
NO_ID = 1 << 63


@dataclass(frozen=True)
class Ranking:
    """``top`` documents an item; ``leaf`` documents in a leaf, or any number of equal vectors."""

    top: int = 10
    leaf: int = 32
    cells: int = 1 << 23
    block_items: int = 512
    block_terms: int = 1 << 13
    bucket_terms: int = 1 << 19


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text, in order."""
    return TERM.findall((text or b"").lower())


def lengths(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """``100 - 90 + (90 * n * docs) div total``; in Python's integers where 64 bits could overflow."""
    if len(n) and 90 * int(n.max()) * docs >= 1 << 63:
        return np.array([10 + 90 * int(x) * docs // total for x in n], np.int64)
    return 10 + 90 * n * docs // total


@dataclass
class Block:
    """Some items over the columns of their own terms."""

    items: list[int]  # running numbers
    ids: list[int | None]
    columns: np.ndarray  # of a term of the bucket: its column here, or -1
    own: list[np.ndarray]  # columns of each item's terms
    weights: list[np.ndarray]  # integer weights of them

    def matrix(self) -> np.ndarray:
        out = np.zeros((int(self.columns.max()) + 1, len(self.items)))
        for i, (own, weight) in enumerate(zip(self.own, self.weights)):
            out[own, i] = weight
        return out


class Tree:
    """A ball tree over the rows of a matrix of integer components; rows are put in the order of the leaves."""

    def __init__(self, vectors: np.ndarray, leaf: int):
        self.order = np.arange(len(vectors))
        self.begin, self.end, self.children, centroids, radii, largest = [], [], [], [], [], []
        todo = [(0, len(vectors), None)]
        while todo:
            begin, end, parent = todo.pop()
            if parent is not None:
                self.children[parent].append(len(self.begin))
            part = vectors[self.order[begin:end]]
            centroid, high = part.mean(axis=0), part.max(axis=0)
            same = bool((high == part.min(axis=0)).all())
            part -= centroid
            square = np.einsum("ij,ij->i", part, part)
            self.begin.append(begin)
            self.end.append(end)
            self.children.append([])
            centroids.append(centroid)
            radii.append(math.sqrt(square.max()))
            largest.append(high)
            if end - begin > leaf and not same:
                far = part[square.argmax()]
                other = part[(square - 2 * (part @ far)).argmax()]
                side = part @ (far - other)
                turn = np.argsort(side, kind="stable")
                cut = int((side <= (far @ far - other @ other) / 2).sum())
                # A cut that leaves nearly all on one side makes deep trees: halve instead.
                cut = cut if min(cut, end - begin - cut) * 16 >= end - begin else (end - begin) // 2
                self.order[begin:end] = self.order[begin:end][turn]
                number = len(self.begin) - 1
                todo += [(begin, begin + cut, number), (begin + cut, end, number)]
        self.centroid, self.radius, self.largest = np.array(centroids), np.array(radii), np.array(largest)
        self.vectors = vectors[self.order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Per node and query, at least the best score below the node; 0 only if no document there has a term of the query."""
        norm = np.sqrt((queries**2).sum(axis=0))
        middle = self.centroid @ queries
        ball = middle + np.outer(self.radius, norm)
        length = np.sqrt((self.centroid**2).sum(axis=1)) + self.radius
        rectangle = self.largest @ queries
        # Sums of n products err by less than n * 2**-53 of the sum of their sizes; twice that, and one for the radius and the root.
        error = (len(queries) + 16) * 2.0**-52
        safe = np.minimum(ball + error * np.outer(length, norm), rectangle * (1 + error)) + 1
        return np.where(rectangle > 0, safe, 0)


class Best:
    """The best (score, id) of one item, ties by the smaller id; those without an id last."""

    def __init__(self, top: int):
        self.top, self.rows = top, []

    @property
    def least(self) -> int:
        """A document below this score cannot enter."""
        return -self.rows[-1][0] if len(self.rows) == self.top else 1

    def offer(self, scores: np.ndarray, ids: list[int]) -> None:
        hit = np.flatnonzero(scores >= self.least)
        if len(hit):
            self.rows = heapq.nsmallest(self.top, self.rows + [(-int(scores[i]), ids[i]) for i in hit])


def search(tree: Tree, ids: list[int], block: Block, queries: np.ndarray, best: list[Best]) -> int:
    """Best-first search of a tree for every item of a block; gives the number of leaves scored."""
    bounds, scored = tree.bounds(queries), 0
    for i, (own, weight, kept) in enumerate(zip(block.own, block.weights, best)):
        bound = bounds[:, i]
        heap = [(-bound[0], 0)]
        while heap and -heap[0][0] >= kept.least:
            node = heapq.heappop(heap)[1]
            if tree.children[node]:
                for child in tree.children[node]:
                    heapq.heappush(heap, (-bound[child], child))
                continue
            begin, end = tree.begin[node], tree.end[node]
            kept.offer(tree.vectors[begin:end][:, own].astype(np.int64) @ weight, ids[begin:end])
            scored += 1
    return scored


def _vectors(docs: DataFrame, number: dict[bytes, int], scratch: Scratch) -> DataFrame:
    """``doc_id, n, term, tf``: length of every document with a term, and its query terms with their counts."""
    numbers = docs.sparkSession.sparkContext.broadcast(number)

    def count(batch) -> Iterator[list]:
        known, ids, sizes, flat, times, offsets = numbers.value, [], [], [], [], [0]
        for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            words = terms(text)
            if not words:
                continue
            held = np.fromiter((known[w] for w in words if w in known), np.int32)
            found, tf = np.unique(held, return_counts=True)
            ids.append(i)
            sizes.append(len(words))
            flat.append(found)
            times.append(tf)
            offsets.append(offsets[-1] + len(found))
        if ids:
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(x).astype(np.int32))) for x in (flat, times)]
            yield [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists]

    table = scratch.write(map_rows(docs, "doc_id long, n long, term array<int>, tf array<int>", count), "vectors")
    numbers.destroy()
    return table


def _blocks(items: list, number: dict[bytes, int], weight: dict[int, int], rule: Ranking, first: int) -> Iterator[Block]:
    """Items in order, cut into blocks; terms that weigh nothing are left out."""

    def made(part: list, begin: int) -> Block:
        every = np.array(sorted({number[t] for r in part for t in r["terms"] if weight.get(number[t])}), np.int64)
        columns = np.full(len(number), -1, np.int64)
        columns[every] = np.arange(len(every))
        own = [np.array(sorted(columns[number[t]] for t in r["terms"] if weight.get(number[t])), np.int64) for r in part]
        weights = [np.array([weight[int(every[c])] for c in cols], np.int64) for cols in own]
        return Block(list(range(begin, begin + len(part))), [r["item_id"] for r in part], columns, own, weights)

    part, held = [], set()
    for i, row in enumerate(items):
        if part and (len(part) == rule.block_items or len(held.union(row["terms"])) > rule.block_terms):
            yield made(part, first + i - len(part))
            part, held = [], set()
        part.append(row)
        held.update(row["terms"])
    if part:
        yield made(part, first + len(items) - len(part))


def _ranked(vectors: DataFrame, block: Block, docs: int, total: int, rule: Ranking) -> DataFrame:
    """``item, item_id, doc_id, score``: every task's best documents per item."""
    shared = vectors.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        queries = block.matrix()
        rows = max(rule.leaf, rule.cells // len(queries))
        best = [Best(rule.top) for _ in block.items]
        for batch in batches:
            for begin in range(0, batch.num_rows, rows):
                part = batch.slice(begin, rows)
                ids, dense = _dense(part, block.columns, len(queries), docs, total)
                if len(ids):
                    tree = Tree(dense, rule.leaf)
                    search(tree, [ids[i] for i in tree.order], block, queries, best)
        found = [(n, i, None if d == NO_ID else d, -s) for n, i, kept in zip(block.items, block.ids, best) for s, d in kept.rows]
        if found:
            kinds = [pa.int64()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=["item", "item_id", "doc_id", "score"])

    return vectors.mapInArrow(run, "item long, item_id long, doc_id long, score long")


def _dense(part: pa.RecordBatch, columns: np.ndarray, width: int, docs: int, total: int) -> tuple[list[int], np.ndarray]:
    """Ids and components of the rows that have a term of the block."""
    term, tf = part.column("term"), part.column("tf")
    row = np.repeat(np.arange(part.num_rows), term.value_lengths().to_numpy())
    column, tf = columns[term.flatten().to_numpy()], tf.flatten().to_numpy().astype(np.int64)
    here = column >= 0
    row, column, tf = row[here], column[here], tf[here]
    some, row = np.unique(row, return_inverse=True)
    m = lengths(part.column("n").to_numpy()[some], docs, total)
    out = np.zeros((len(some), width))
    out[row, column] = 1_000_000_000 * tf // (1000 * tf + 8 * m[row])
    ids = part.column("doc_id")
    return [NO_ID if (d := ids[int(i)].as_py()) is None else d for i in some], out


def rank_documents(
    docs: DataFrame, items: DataFrame, rule: Ranking = Ranking(), id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", query_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``rule.top`` documents of highest score above 0, ties by ascending id.

    Terms are maximal runs of characters other than ASCII that is neither digit nor letter, with A-Z lower-cased.  The score
    of a document is the sum over the item's distinct terms of ``w * ((1000000000 * tf) div (1000 * tf + 8 * m))``, where
    ``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and ``m = 10 + (90 * n * N) div L``.

    Texts that are null or have no term are no documents and no items; such an item has no rows.  Every row of ``docs`` is a
    document, also under a repeated id; rows without an id come last among equal scores.  Equal rows of ``items`` are one
    item; rows of one item id with other texts are items of their own under the same id.  Other columns are not looked at;
    an empty table on either side gives no rows.  Texts are read whole.
    """
    spark, scratch = docs.sparkSession, Scratch(docs)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).where("text is not null")
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(query_col).cast("binary").alias("text")).distinct()

    def cut(batch) -> Iterator[list]:
        words = [sorted(set(terms(t))) for t in batch.column("text").to_pylist()]
        yield [batch.column("item_id"), pa.array(words, pa.list_(pa.binary()))]

    asked = scratch.write(map_rows(asked, "item_id long, terms array<binary>", cut).where(F.size("terms") > 0), "items")
    size = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    buckets = max(1, -(-size // rule.bucket_terms))
    found = []
    first = 0
    for bucket in range(buckets):
        # About bucket_terms terms; one item is never cut.
        some = asked.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(buckets)) == bucket)
        held = [{"item_id": r["item_id"], "terms": [bytes(t) for t in r["terms"]]} for r in some.orderBy("item_id", "terms").collect()]
        number = {t: i for i, t in enumerate(sorted({t for r in held for t in r["terms"]}))}
        vectors = _vectors(docs, number, scratch)
        n_docs, total = vectors.agg(F.count("*"), F.sum("n")).first()
        # At most one row per term of the bucket.
        df = vectors.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow().to_pydict()
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for t, k in zip(df["term"], df["df"])}
        for block in _blocks(held, number, weight, rule, first):
            if block.columns.max(initial=-1) >= 0:
                found.append(scratch.write(_ranked(vectors, block, n_docs, total, rule), "ranked"))
        first += len(held)
        scratch.remove(vectors)
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    every = found[0]
    for table in found[1:]:
        every = every.unionByName(table)
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    every = every.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= rule.top)
    return every.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
