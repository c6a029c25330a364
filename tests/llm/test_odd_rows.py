"""Rows without an id, ids on many rows and clashing column names in near duplicates, shards and the mix."""

from __future__ import annotations

import collections
import random
import uuid

import numpy as np

from parley.llm import mixing, near, sharding, stages
from parley.llm.queries import TARGETS
from parley.runtime import scratch_path


def chain(draw, steps):
    """Texts in which each is near the next and not the one after."""
    words = [f"w{draw.randrange(10**9)}" for _ in range(100)]
    out = []
    for _ in range(steps):
        out.append(" ".join(words))
        at = draw.randrange(80)
        words = words[:at] + [f"n{draw.randrange(10**9)}" for _ in range(6)] + words[at + 6 :]
    return out


def test_rows_without_an_id_link_others(spark, docs_of):
    draw = random.Random(1)
    a, b, c = chain(draw, 3)
    sets = [set(zip(t.split(), t.split()[1:])) for t in (a, b, c)]
    like = lambda x, y: 100 * len(x & y) >= 80 * len(x | y)
    assert like(sets[0], sets[1]) and like(sets[1], sets[2]) and not like(sets[0], sets[2])
    got = near.near_duplicates(docs_of((4, a), (None, b), (None, b), (7, c), (None, "alone in this"), (9, None)), near.Likeness(words=2))
    rows = {(r.doc_id, r.component_id, r.kept) for r in got.collect()}
    assert rows == {(4, 4, True), (None, 4, False), (7, 4, False), (None, None, True), (9, 9, True)}


def test_families_of_many_small_texts_are_cut_into_blocks(spark, docs_of, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_SHINGLES", 800)
    draw = random.Random(2)
    texts = chain(draw, 40) + [f"lone{i} " * 3 + f"x{i} y{i}" for i in range(10)]
    order = list(range(len(texts)))
    draw.shuffle(order)
    got = near.near_duplicates(docs_of(*((i, texts[i]) for i in order)), near.Likeness(words=2)).collect()
    assert all(r.component_id == (0 if r.doc_id < 40 else r.doc_id) for r in got)


def test_shards_of_one_id_on_many_rows_are_even(spark, docs_of):
    draw = random.Random(3)
    rows = [(i, "x" * draw.randint(50, 150)) for i in range(2000)] + [(None, "y" * 100)] * 700 + [(5, "z" * draw.randint(50, 150)) for _ in range(300)]
    got = sharding.shard_documents(docs_of(*rows), shards=8).collect()
    load, places = collections.Counter(), collections.defaultdict(list)
    for r in got:
        load[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert len(got) == len(rows) and max(load.values()) < 1.05 * min(load.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_a_stored_map_is_edited(spark, docs_of):
    """The grown table moves few records of the old one, and what was stored stays as it was."""
    draw, path = random.Random(4), scratch_path(spark, f"maps-{uuid.uuid4().hex}")
    rows = [(i, "x" * draw.randint(1, 200)) for i in range(3000)]
    where = lambda table: {r.doc_id: r.shard for r in sharding.shard_documents(table, shards=6, slots=512, maps=path).collect()}
    first = where(docs_of(*rows[:2500]))
    assert sharding.versions(spark, path) == [1]
    stored = sharding.load_map(spark, path, 1)
    assert where(docs_of(*rows[:2500])) == first and sharding.versions(spark, path) == [1]
    second = where(docs_of(*rows))
    assert sharding.versions(spark, path) == [1, 2] and sharding.load_map(spark, path, 1) == stored
    assert 0 < sum(second[i] != s for i, s in first.items()) < 0.1 * len(first)


def test_shards_with_clashing_names(spark):
    table = spark.createDataFrame([(1, "a", 5, 6, 7), (None, None, 5, 6, 7)], "doc_id long, text string, vslot int, shard int, number int")
    assert sorted(r["size"] for r in sharding.shard_documents(table).collect()) == [8, 9]


def test_mix_with_clashing_names_and_without_ids(spark):
    draw = random.Random(5)
    rows = [(None if i % 2 else i, f"text {i} " * draw.randint(1, 60), draw.choice(["src1", None, "zz"]), "en", 0.5, 0.25, "mine", i) for i in range(400)]
    schema = "doc_id long, text string, source string, lang string, mix_weight double, Mix_probability double, mix_source string, row int"
    table = spark.createDataFrame(rows, schema)
    mixed = mixing.mix(table, TARGETS, budget_tokens=sum(len(r[1].split()) for r in rows) // 2).collect()
    assert len(mixed) == 400 and {r.mix_source for r in mixed} == {"src1", "other"} and {r.row for r in mixed} == set(range(400))
    kept = [r for r in mixed if r.mix_kept and r.doc_id is None]
    assert 40 < len(kept) < 160
    stage = stages.source_mix(spark, table, "")
    assert stage.columns == table.columns and {r.mix_source for r in stage.collect()} == {"mine"}
    assert mixing.mix(table.limit(0), TARGETS).count() == 0
    assert np.isclose(sum(r.mix_tokens for r in mixed), sum(len(r[1].split()) for r in rows))
