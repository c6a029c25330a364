"""Ranked search, spelling variants and substring dedup against plain loops, and the odd cases their docstrings define."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from parley.llm import repeats, search, spelling, wordhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- substring dedup


def plain_repeats(rows, window):
    """Kept text, words and removed words per row; None sorts last, rows of one id do not precede each other."""
    order = lambda i: repeats.NO_ID if i is None else i
    first = {}
    for i, text in rows:
        words = plain_words(text)
        for s in range(len(words) - window + 1):
            key, at = tuple(words[s : s + window]), (order(i), s)
            first[key] = min(first.get(key, at), at)
    out = []
    for i, text in rows:
        words = plain_words(text)
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] < (order(i), s):
                gone.update(range(s, s + window))
        out.append((i, " ".join(w for j, w in enumerate(words) if j not in gone), len(words), len(gone)))
    return sorted(out, key=repr)


def cut(spark, rows, rule):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, tag string")
    got = repeats.cut_repeats(df.withColumn("seed", df["tag"]).withColumn("pos", df["tag"]), rule).collect()
    for r in got:
        assert r.n_removed == sum(s["end"] - s["begin"] for s in r.spans)
        assert all(a["end"] < b["begin"] for a, b in zip(r.spans, r.spans[1:]))
    return sorted([(r.doc_id, r.text, r.n_words, r.n_removed) for r in got], key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_equal_a_plain_loop(spark, seed):
    """Few words, so that passages meet by chance in every way: cut at borders, nested, overlapping themselves, in runs of one word."""
    draw = random.Random(seed)
    passages = [[draw.choice("ab") for _ in range(draw.randint(5, 30))] for _ in range(6)]
    rows = []
    for i in range(80):
        words = []
        while len(words) < draw.randint(0, 60):
            words += draw.choice(passages) if draw.random() < 0.5 else [draw.choice("abcdef")] * draw.randint(1, 9)
        rows.append((draw.choice([i, i, i, i // 2, None]), draw.choice([" ", "\t", "\n\x0b"]).join(words)))
    rows += [(200, None), (201, ""), (202, " \n "), rows[3], rows[3], (203, "a " * 400)]
    rule = repeats.Repeats(window=7, seed=3)
    assert cut(spark, rows, rule) == plain_repeats(rows, 7)


def test_repeats_in_full_length(spark):
    """A passage shared by many texts, with other words on both sides, goes from all but the first; a shorter one stays."""
    passage, short = [f"p{i}" for i in range(55)], [f"s{i}" for i in range(19)]
    rows = [(i, " ".join([f"l{i}.{j}" for j in range(i % 30)] + passage + [f"r{i}.{j}" for j in range(25)] + short)) for i in range(60)]
    rows += [(100 + i, rows[5][1]) for i in range(20)] + [(500, "Ä É ß  x " * 3)]
    got = cut(spark, rows, repeats.Repeats())
    assert got == plain_repeats(rows, 20)
    kept = {r[0]: r for r in got}
    assert kept[0][3] == 0 and kept[59][3] == 55 and kept[110][1] == "" and kept[500][3] == 0


def test_repeats_of_nothing_and_case(spark):
    assert cut(spark, [], repeats.Repeats()) == []
    text = " ".join(f"Word{i}" for i in range(40))
    assert [r[3] for r in cut(spark, [(1, text), (2, text.lower()), (3, text)], repeats.Repeats())] == [0, 0, 40]


def test_windows_share_a_seed_at_one_offset():
    """Whatever stands beside a window, the seed chosen in it for its own sake is among the seeds."""
    draw, rule = np.random.default_rng(5), repeats.Repeats()
    window = draw.integers(1, 2**63, 20, dtype=np.uint64)
    (own,) = repeats.seeds(window, np.zeros(20, int), rule)
    for _ in range(50):
        left, right = (draw.integers(1, 2**63, draw.integers(0, 40), dtype=np.uint64) for _ in range(2))
        words = np.concatenate([left, window, right])
        assert own + len(left) in repeats.seeds(words, np.zeros(len(words), int), rule)


# --- spelling variants


def plain_vocabulary(rows, rule):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if rule.slip and h % rule.slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= rule.min_letters and n >= rule.min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, rule):
    words = plain_vocabulary(rows, rule)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        top = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = top if top is not None and words[top] >= rule.ratio * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def told(spark, rows, rule):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, word string, n string")
    return sorted(tuple(r) for r in spelling.variants(df, rule).select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("segment_words", [1 << 22, 50])
def test_variants_equal_a_plain_loop(spark, segment_words):
    """Many close words of few letters, umlauts and upper-case accents; with small segments, in several passes."""
    draw = random.Random(7)
    stems = ["".join(draw.choice("aabcéÉÿ") for _ in range(draw.randint(3, 7))) for _ in range(60)]
    rows = []
    for i in range(300):
        words = [draw.choice(stems[: draw.choice([2, 5, 60])]) for _ in range(40)]
        for j, w in enumerate(words):
            at = draw.randrange(len(w))
            words[j] = draw.choice([w, w, w.upper(), w[:at] + w[at + 1 :], w[:at] + draw.choice("xbé") + w[at:], w[:at] + "b" + w[at + 1 :]])
        rows.append((draw.choice([i, i, 7, None]), draw.choice([" ", "1", ", ", "Ā"]).join(words)))
    rows += [(900, None), (901, ""), rows[0], rows[0], (902, "q" * 3000 + " "), *[(903, "q" * 3000)] * 6, *[(904 + k, "q" * 2999 + "r") for k in range(7)]]
    rule = spelling.Spelling(min_letters=4, min_count=2, ratio=2, slip=5, segment_words=segment_words)
    expected = plain_variants(rows, rule)
    assert sum(r[1] is not None for r in expected) > 50 and any(r[1] is not None and r[2] != r[1] for r in expected)
    assert told(spark, rows, rule) == expected


def test_variants_of_nothing(spark):
    assert told(spark, [], spelling.Spelling()) == []
    assert told(spark, [(1, None), (2, "12 34 short")], spelling.Spelling()) == []
    lonely = [(i, "solitary") for i in range(10)]
    assert told(spark, lonely, spelling.Spelling(slip=0)) == [("solitary", None, "solitary", 10, 0, None)]


def test_form_ties_go_to_the_smaller_word(spark):
    rows = [(1, "kettle " * 5 + "kettlz " * 30 + "kettla " * 30)]
    assert told(spark, rows, spelling.Spelling(slip=0))[1][:3] == ("kettle", "kettla", "kettla")


def test_every_edit_is_generated_once():
    word = "abbé"
    made = set()
    for rows, at, letter, hashes, size in spelling.edits(spelling._codes([word], len(word))):
        for a, c, h in zip(at.tolist(), letter.tolist(), hashes.tolist()):
            new = word[:a] + (chr(c) if c else "") + word[a + 1 :]
            assert new not in made and len(new) == size
            made.add(new)
            assert h == int(wordhash.mix(spelling.word_hashes(spelling._codes([new], size)))[0])
    letters = [chr(c) for c in spelling.LETTERS]
    deleted = {word[:i] + word[i + 1 :] for i in range(4)}
    assert made == deleted | {word[:i] + c + word[i + 1 :] for i in range(4) for c in letters if c > word[i]}


# --- ranked search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_ranking(docs, items, top):
    held = [(i, Counter(TERM.findall(t.translate(LOWER)))) for i, t in docs if t is not None]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in sorted(set(items), key=repr):
        scores = []
        for i, c in held:
            m = 10 + (90 * sum(c.values()) * n_docs) // total
            score = 0
            for t in set(TERM.findall((text or "").translate(LOWER))) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, search.NO_ID if i is None else i))
        for rank, (score, i) in enumerate(sorted(scores)[:top], 1):
            out.append((item, rank, None if i == search.NO_ID else i, -score))
    return sorted(out, key=repr)


def ranked(spark, docs, items, rule):
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score int, item_id int").repartition(3)
    items = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    return sorted([tuple(r) for r in search.rank_documents(docs, items, rule).collect()], key=repr)


def corpus(seed, n=250):
    draw = random.Random(seed)
    words = [f"w{int(draw.paretovariate(0.7))}" for _ in range(4000)]
    docs = [(draw.choice([i, i, i, 5, None]), " ".join(draw.choices(words, k=draw.randint(0, 80)))) for i in range(n)]
    docs += [docs[2]] * 15 + [(1000, None), (1001, ""), (1002, "?!"), (1003, " ".join(words)), (1004, "ÄB äB É x W1W2")]
    items = [(i, " ".join(draw.choices(words, k=draw.randint(1, 12)))) for i in range(25)]
    return docs, items + [items[0], (3, "w1 W2 w3"), (50, None), (51, ""), (52, "nowhere"), (None, "w2 w4"), (53, "äB Äb É X")]


@pytest.mark.parametrize("rule", [
    search.Ranking(), search.Ranking(leaf=2), search.Ranking(leaf=3, cells=900, block_items=4, block_terms=30, bucket_terms=60, top=3),
])
def test_ranking_equals_a_plain_loop(spark, rule):
    docs, items = corpus(11)
    assert ranked(spark, docs, items, rule) == plain_ranking(docs, items, rule.top)


def test_ranking_of_nothing(spark):
    assert ranked(spark, [], [(1, "a b")], search.Ranking()) == []
    assert ranked(spark, [(1, "a b")], [], search.Ranking()) == []
    assert ranked(spark, [(1, None), (2, "")], [(1, "a b")], search.Ranking()) == []


def test_bounds_hold_and_prune():
    """No document beats its nodes' bounds, and groups of like documents are left unopened."""
    draw = np.random.default_rng(3)
    centres = draw.integers(0, 900_000, (40, 60)) * (draw.random((40, 60)) < 0.2)
    vectors = (np.repeat(centres, 25, axis=0) * (1 + draw.random((1000, 60)) / 50)).astype(np.int64).astype(float)
    tree = search.Tree(vectors, 8)
    queries = draw.integers(0, 9000, (60, 30)) * (draw.random((60, 30)) < 0.15)
    bounds, scores = tree.bounds(queries.astype(float)), tree.vectors.astype(np.int64) @ queries
    for node, (begin, end) in enumerate(zip(tree.begin, tree.end)):
        assert (scores[begin:end].max(axis=0) <= bounds[node]).all()
    own = [np.flatnonzero(q) for q in queries.T]
    block = search.Block(list(range(30)), list(range(30)), np.arange(60), own, [q[o] for q, o in zip(queries.T, own)])
    best = [search.Best(10) for _ in range(30)]
    opened = search.search(tree, list(range(1000)), block, queries.astype(float), best)
    leaves = sum(not c for c in tree.children)
    assert opened < 30 * leaves / 4
    for i, kept in enumerate(best):
        assert [-s for s, _ in kept.rows] == sorted((s for s in scores[:, i].tolist() if s > 0), reverse=True)[:10]


def test_lengths_beyond_64_bits():
    assert search.lengths(np.array([10**12, 7]), 10**10, 10**15).tolist() == [10 + 90 * 10**12 * 10**10 // 10**15, 10]
