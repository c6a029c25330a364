"""Sharding, mixing, archive, language ID, main text and the pipeline: against brute force, round trips and held-out rows."""

import collections
import hashlib
import os
import random
import uuid
import zlib

import corpus_pipeline
import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from parley import runtime
from parley.llm import decontaminate, html, langid, mixing, near, queries, sharding, stages, warc

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def places_are_gapless(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    return all(sorted(s) == list(range(len(s))) for s in by.values())


def test_shards_are_even_and_gapless(spark, documents):
    rows = queries.op4_virtual_slots(spark, SF).collect()
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    load = collections.Counter()
    for r in rows:
        data = texts[r.doc_id].encode()
        assert r.size == len(data) + 8 and r.text_crc32 == zlib.crc32(data) and r.law == "bytes" and r.grown_shard is None
        load[r.shard] += r.size
    assert len(rows) == len(texts) and set(load) <= set(range(24)) and places_are_gapless(rows)
    mean = sum(load.values()) / 24
    largest = max(r.size for r in rows)
    assert max(load.values()) <= max(mean * 1.1, largest * 1.2)


def test_shards_of_odd_tables(spark, docs_of):
    rows = sharding.shard_documents(docs_of((None, None), (1, ""), (1, ""), (2, "x" * 50_000), (None, "é")), shards=3).collect()
    assert sorted(r.size for r in rows) == [8, 8, 8, 10, 50_008] and places_are_gapless(rows)
    assert sharding.shard_documents(docs_of()).count() == 0


def test_map_versions_move_few_slots(spark):
    rng = random.Random(4)
    weights = {s: rng.randint(1, 1000) for s in range(400)}
    first = sharding.new_map(weights, 8, 400)
    grown = sharding.rebalanced(first, weights, 9)
    load = collections.Counter()
    for s, shard in grown.items():
        load[shard] += weights[s]
    assert max(load.values()) - min(load.values()) < 1000
    moved = [s for s in first if first[s] != grown[s]]
    assert all(grown[s] == 8 for s in moved) or len(moved) < 100
    path = f"{runtime.shared_folder(spark)}/{uuid.uuid4().hex}"
    sharding.save_map(spark, first, 1, path)
    sharding.save_map(spark, grown, 2, path)
    assert sharding.load_map(spark, path, 1) == first and sharding.load_map(spark, path, 2) == grown


def test_raking_meets_all_margins():
    rng = np.random.default_rng(1)
    cells = {(s, l, t): int(rng.integers(1, 1000)) for s in "abc" for l in "xy" for t in "uv"}
    targets = mixing.Targets(dict(a=1, b=2, c=3), dict(x=0.7, y=0.3), dict(u=0.5, v=0.5, absent=9))
    weights = mixing.rake(cells, targets)
    total = sum(cells.values())
    for axis, wanted in ((0, dict(a=1 / 6, b=2 / 6, c=3 / 6)), (1, dict(x=0.7, y=0.3)), (2, dict(u=0.5, v=0.5))):
        for value, share in wanted.items():
            assert abs(sum(cells[k] / total * weights[k] for k in cells if k[axis] == value) - share) < 1e-6
    assert mixing.rake({}, targets) == {}


def test_mix_draws_by_probability(spark, docs_of):
    rows = [(i, "word " * 100, "en" if i % 4 else "de", f"s{i % 2}") for i in range(4000)] + [(None, None, None, None), (1, "", "en", "s1")]
    targets = mixing.Targets(dict(s0=0.5, s1=0.5, other=0.1), dict(en=0.5, de=0.5, other=0.1), dict(short=1))
    out = mixing.mix(docs_of(*rows).withColumn("share", F.lit(1)), targets).collect()
    assert len(out) == 4002 and max(r.mix_probability for r in out) == 1.0
    by = collections.defaultdict(lambda: [0, 0.0])
    for r in out:
        by[r.mix_source, r.mix_lang][0] += r.mix_kept
        by[r.mix_source, r.mix_lang][1] += r.mix_probability
    assert all(abs(kept - expected) <= 5 * max(expected, 1) ** 0.5 for kept, expected in by.values())
    small = mixing.mix(docs_of(*rows), targets, budget_tokens=20_000).where("mix_kept").agg(F.sum("mix_tokens")).first()[0]
    assert 10_000 < small < 30_000
    assert mixing.mix(docs_of(), targets).count() == 0


def test_a_scarce_value_does_not_thin_the_mix(spark, docs_of):
    langs = ["en"] * 14 + ["de"] * 4 + ["fr"] * 4 + ["es"] * 3
    rows = [(i, "word " * 500, langs[i // 20 % 25], f"src{i % 20}") for i in range(4000)]
    topic = F.element_at(F.array(*map(F.lit, ["article"] * 49 + ["long"] * 47 + ["short"] * 2 + ["table"] * 2)), (F.xxhash64("doc_id") % 50 + 51).cast("int"))
    for odd in ((9000, "word " * 500, "en", None), (9000, "word " * 500, None, "src3"), (9000, "|" * 500, None, "unlisted")):
        out = mixing.mix(docs_of(*rows, odd), queries.TARGETS, topic).where("mix_kept").collect()
        assert len(out) > 3800 and any(r.doc_id == 9000 for r in out)
    # A listed source with a single document, too, is kept whole and leaves the rest as it is.
    out = mixing.mix(docs_of(*(r for r in rows if r[3] != "src7" or r[0] == 7)), queries.TARGETS, topic).where("mix_kept").collect()
    assert len(out) > 3500 and any(r.doc_id == 7 for r in out)
    part = mixing.mix(docs_of(*rows, (9000, "word " * 500, "en", None)), queries.TARGETS, topic, budget_tokens=1_000_000).where("mix_kept").count()
    assert 1800 < part < 2200


def test_archive_round_trip(spark):
    big = "<p>é</p>" * 200
    rows = [(1, "u1", big), (5, "u5", big), (3, "u\r\n3", big), (2, None, "small"), (4, "u4", "small"), (6, "u6", None), (None, "n", big), (5, "u5", big), (7, "u7", "x" * 300_000)]
    path = f"{runtime.shared_folder(spark)}/{uuid.uuid4().hex}"
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)), path)
    got = sorted(((r.page_id or 0, r.record_type, r.refers_to) for r in warc.read_archive(spark, path).collect()))
    assert got == sorted(
        [(0, "revisit", 5), (1, "revisit", 5), (2, "response", None), (3, "revisit", 5), (4, "response", None),
         (5, "response", None), (5, "response", None), (6, "response", None), (7, "response", None)]
    )
    for r in warc.read_archive(spark, path).collect():
        payload = next(h for i, _, h in rows if i == r.page_id) or ""
        assert bytes(r.payload) == payload.encode() and r.payload_bytes == len(payload.encode())
        assert r.payload_digest == hashlib.sha1(payload.encode()).hexdigest() and r.header.startswith(b"WARC/1.1\r\n")
    assert spark.read.parquet(f"{path}/payloads").count() == 4


def test_language_of_held_out_rows(spark, documents):
    rows = langid.identify(documents).join(documents.select("doc_id", "lang", F.length("text").alias("n")), "doc_id").collect()
    held = [r for r in rows if r.held_out and r.n > 100]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)


def test_language_of_odd_texts(spark, docs_of):
    base = [(i, ("der hund und die katze " if i % 2 else "the dog and the cat ") * 9, "de" if i % 2 else "en") for i in range(40)]
    odd = [(100, None), (101, ""), (102, "123 !?"), (103, "der hund"), (None, "the dog", None), (104, "the cat and " * 20_000, None)]
    rows = {r.doc_id: r for r in langid.identify(docs_of(*base, *odd)).collect()}
    assert [rows[i].lang_pred for i in (100, 101, 102, 103, 104, None)] == ["und", "und", "und", "de", "en", "en"]
    assert rows[100].rejected and rows[100].score == 0 and not rows[104].rejected
    assert {r.lang_pred for r in langid.identify(docs_of((1, "no label", None))).collect()} == {"und"}
    clash = docs_of(*base).withColumn("lang_pred", F.lit(1)).withColumn("c0", F.lit("x"))
    assert langid.identified(clash).columns == clash.columns and langid.identified(clash).count() == 40


PAGE = """<html><body><div class=top><a href=/>Start page</a> <a href=/x>About</a></div><nav><ul><li><a>Menu one</a></li></ul></nav>
<div class="post-content"><h1>The  title &amp; more</h1><p>First paragraph of some length, with a full stop. And more text to it.<p>Second one,
 broken over lines&nbsp;here. It goes on for a while, to look like prose.<script>no()</script></p><div class="ad">Buy this thing now</div>
<p><b>Third paragraph without an end of bold. It has enough words to be read as prose.<br><p>Fourth and last paragraph, which also has a few words.</p></div>
<div class="comments"><div class="comment"><p>A reader says that this was a good text.</p></div></div><footer>&copy; us</footer></body></html>"""


def test_main_text(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = html.fit(pages, html.Training(sample_pages=40, layouts=4))
    odd = [(1, "u", PAGE), (2, "u", None), (3, "u", ""), (4, None, "<<< <p"), (5, "u", "<!-- only a comment"), (6, "u", "<p>" * 3000), (7, "u", "</div></p><table><td>")]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(odd, "page_id long, url string, html string"), model).collect()}
    assert got[1].split("\n\n")[0] == "The title & more" and "Buy this" not in got[1] and "reader" not in got[1] and "Menu" not in got[1]
    assert "Second one, broken over lines here." in got[1] and got[1].endswith("which also has a few words.") and "no()" not in got[1]
    assert got[2] == got[3] == got[5] == ""
    x, y = html.training_rows([r.html for r in pages.orderBy("page_id").tail(8)], 3, 99)
    assert ((model.chance(x) > 0.5) == y).mean() > 0.97
    assert html.fit(pages.limit(0)) is None and html.extract(pages.limit(0), None).count() == 0


PROSE = [f"Paragraph {i} of the article has some length, and a full stop. It goes on for a while, to look like prose." for i in "abcdef"]


def test_main_text_without_blocks_and_after_open_elements(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = html.fit(pages, html.Training(sample_pages=40, layouts=4))
    loose = "<html><body>" + "<br><br>".join(["<a href=/>Start</a> | <a href=/x>About</a> | <a href=/y>More</a>", PROSE[0], f"<b>{PROSE[1]}</b>", *PROSE[2:]]) + "</body></html>"
    whole = "<article>" + "".join(f"<p>{p}</p>" for p in PROSE) + "</article>"
    odd = ["<svg width=1 />", "<video src=a.mp4 />", "<noscript>", "<template>", "<iframe src=x>", "<canvas><video src=a /><video src=b>old</video>", "<svg><svg/><path></svg>"]
    rows = [(0, "u", loose)] + [(i, "u", f"<html><body>{o}{whole}</body></html>") for i, o in enumerate(odd, 1)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()}
    assert got == {i: "\n\n".join(PROSE) for i in range(len(rows))}
    hidden = html.parse("<p>a</p><svg><svg>x</svg>y</svg><noscript>z</noscript><script>q</script><!-- <video> --><p>b</p><style>c")
    assert [t for _, t in hidden.runs] == ["a", "b"]


def test_labels_never_contradict():
    rng = np.random.default_rng(7)
    for _ in range(50):
        parent = [-1] + [int(rng.integers(0, i)) for i in range(1, 12)]
        main = html.decode(parent, rng.random(12))
        assert all(not main[i] or main[parent[i]] for i in range(1, 12))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_with_sql(spark, name):
    con = oracle.connect("/root/testdata/sf0.01")
    assert not oracle.difference(queries.QUERIES[name](spark, "/root/testdata/sf0.01"), con, queries.ORACLE[name])


def test_pipeline_stage_by_stage(spark, documents):
    """Each stage's rows are what its operator says of the rows before it; the last is the result of run()."""
    kept = {}
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, runtime.materialise(stage(spark, docs, SF), "test")
        kept[name] = {r.doc_id for r in docs.collect()}
        if name != "shards":
            assert docs.columns == documents.columns
        if name == "near_dedup":
            assert kept[name] == {r.doc_id for r in near.near_duplicates(before, near.Likeness(words=5)).where("kept").collect()}
        if name == "decontamination":
            items = spark.read.parquet(f"{SF}/benchmark.parquet")
            hit = {r.doc_id for r in decontaminate.contaminated(before, items).collect()}
            assert kept[name] == kept["near_dedup"] - hit
            plain = {d.doc_id for d in before.collect() for b in items.collect() if " ".join(b.text.split()) in " ".join((d.text or "").split())}
            assert plain <= hit
    assert kept["source_mix"] <= kept["decontamination"] <= kept["near_dedup"] <= kept["language"] and kept["shards"] == kept["source_mix"]
    assert len(kept["language"]) > 0.95 * documents.count()
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()} == {tuple(r) for r in docs.collect()}


def test_pipeline_stages_bear_odd_rows(spark, docs_of):
    rows = [(i, " ".join(f"der{k} und die" for k in range(i, i + 30)), "de") for i in range(0, 400, 40)]
    rows += [(None, None, None, None), (1, None), (2, ""), (3, "123"), (rows[0]), (None, "the " * 50, None, None)]
    docs = docs_of(*rows).withColumn("n_chars", F.length("text").cast("long")).withColumn("lang_pred", F.lit(1)).withColumn("kept", F.lit(1))
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, SF)
            assert out.count() <= table.count() and (name == "shards" or out.columns == docs.columns)


def test_archive_keeps_no_copy_of_its_record_keys(spark, tmp_path, monkeypatch):
    labels, kept = [], warc.materialise
    monkeypatch.setattr(warc, "materialise", lambda df, label: labels.append((label, df.columns)) or kept(df, label))
    pages = spark.createDataFrame([(i, f"u{i}", "x" * 2000 if i < 3 else f"y{i}") for i in range(5)], "page_id long, url string, html string")
    warc.write_archive(pages, str(tmp_path / "archive"))
    assert labels == [("holders", ["digest", "holder"])]
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_archive(spark, str(tmp_path / "archive")).collect()}
    assert got == {0: ("revisit", 2), 1: ("revisit", 2), 2: ("response", None), 3: ("response", None), 4: ("response", None)}
