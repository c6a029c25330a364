"""Quality verdicts against a plain loop, in several languages and scripts."""

from __future__ import annotations

import collections
import math
import random
import re
import unicodedata

from parley.llm import quality

WORDS = {
    "ru": "и в не на что он с как это по она так его но слово дело жизнь день город ночь".split(),
    "it": "il di che e la a per un in una mi sono ho non cosa tempo vita giorno casa parola".split(),
    "pl": "nie to się w na i z że do jest jak ale dzień człowiek życie ręka miasto dom noc rok".split(),
    "en": "the of and to in a is that it was river mountain house road winter letter table music stone paper".split(),
    "zh": "的一是不了人我在有他这中大来上国个到说们 为子和你地出 道也时年得就".split(),
}
RULES = quality.Rules(min_rows=8)


def text(draw, lang, n=120):
    if lang == "zh":
        return "".join(draw.choice("".join(WORDS["zh"])) + draw.choice(["", "", "，", "。 ", " "]) for _ in range(3 * n))
    return " ".join(draw.choice(WORDS[lang][: draw.choice([8, 20])]) + draw.choice(["", "", ",", ".", " 7"]) for _ in range(n)).capitalize()


def kind(c):
    if c in " \t\n\x0b\x0c\r":
        return None
    if c in "#*$%&|<>":
        return "symbol"
    if c in ".,;:!?、。！，：；？،؛؟۔।…":
        return "stop"
    major = unicodedata.category(c)
    if major in ("Ll", "Lu"):
        return {"Ll": "lower", "Lu": "upper"}[major]
    return {"L": "letter", "M": "letter", "N": "digit", "P": "mark", "S": "mark"}.get(major[0], "rest")


def divergence(counts, shares):
    total = max(sum(counts), 1)
    p = [c / total for c in counts]
    part = lambda a, b: sum(x * math.log2(x / ((x + y) / 2)) for x, y in zip(a, b) if x > 0)
    return math.sqrt(max((part(p, shares) + part(shares, p)) / 2, 0))


def plain(rows):
    """Distances and verdict per id; base verdicts are checked elsewhere."""
    cut = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    bare = lambda w: re.sub(r"^[\W_]+|[\W_]+$", "", w.lower())

    def failed(t):
        w = cut(t)
        n = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if n[tuple(w[k : k + 5])] > 1 for j in range(5)}
        return len(w) < 10 or 100 * len(covered) > 20 * len(w)

    top = {}
    for lang in {r[2] for r in rows} - {None}:
        texts = [t for _, t, x in rows if x == lang and len(cut(t)) >= 10]
        docs = collections.Counter(w for t in texts for w in {bare(w) for w in cut(t)} - {""})
        if len(texts) >= RULES.min_rows:
            first = sorted(docs, key=lambda w: (-docs[w], w))[: RULES.top_words]
            top[lang] = [w for w in first if docs[w] >= RULES.min_share * len(texts)]

    def histograms(t, lang):
        names = [*quality.CLASSES, "rest"]
        classes = collections.Counter(filter(None, map(kind, t or "")))
        found = collections.Counter(re.findall(r"[^\W_]+", (t or "").lower()))
        own = [found[w] for w in top.get(lang, [])]
        return [classes[n] for n in names], [*own, max(len(cut(t)) - sum(own), 0)]

    share = lambda c: [x * 1_000_000 // max(sum(c), 1) for x in c]
    known = {}
    for lang in top:
        good = [histograms(t, lang) for _, t, x in rows if x == lang and not failed(t)]
        if len(good) >= RULES.min_rows:
            sums = [[sum(col) for col in zip(*(share(h[i]) for h in good))] for i in (0, 1)]
            known[lang] = [[v / max(sum(s), 1) for v in s] for s in sums]
    merged = lambda c: [sum(c[:3]), *c[3:]]
    out = {}
    for i, t, lang in rows:
        classes, words = histograms(t, lang)
        long_enough = len(cut(t)) >= RULES.min_words and sum(map(len, cut(t))) >= RULES.min_chars
        a = b = None
        if long_enough and lang is None and known:
            a = min(divergence(merged(classes), merged(c)) for c, _ in known.values())
        elif long_enough and lang in known:
            a, b = divergence(classes, known[lang][0]), divergence(words, known[lang][1])
        out[i] = (a, b, failed(t), not failed(t) and (a or 0) <= RULES.max_class_distance and (b or 0) <= RULES.max_word_distance)
    return out


def corpus():
    draw = random.Random(3)
    rows = [(100 * k + i, text(draw, lang), lang) for k, lang in enumerate(WORDS) for i in range(12)]
    rows += [(900, text(draw, "ru"), None), (901, text(draw, "it"), "xx"), (902, text(draw, "en").upper(), "en"), (903, "#$% &&& 12 ***x " * 5, "en")]
    rows += [(904, " ".join(f"{w}### {i}$$$" for i, w in enumerate(text(draw, "en").split())), lang) for lang in ("en",)]
    rows += [(905, " ".join(f"{w}### {i}$$$" for i, w in enumerate(text(draw, "pl").split())), None)]
    rows += [(906, " ".join(f"qo{i}" for i in range(100)), "it"), (907, None, "en"), (908, "", None), (909, text(draw, "en", 4000), "en")]
    return rows


def test_verdicts_equal_a_plain_loop(spark):
    rows = corpus()
    table = spark.createDataFrame([(*r, 1, 2, "n") for r in rows], "doc_id long, text string, lang string, classes int, n_words int, word string")
    got = {r.doc_id: r for r in quality.judge(table, RULES).collect()}
    for i, (a, b, failed, kept) in plain(rows).items():
        r = got[i]
        assert (r.base_failed, r.kept) == (failed, kept), i
        for mine, theirs in ((r.class_distance, a), (r.word_distance, b)):
            assert (mine is None) == (theirs is None) and abs((mine or 0) - (theirs or 0)) < 1e-9, i


def test_every_language_and_script_is_kept_and_junk_is_not(spark, docs_of):
    rows = corpus()
    got = {r.doc_id: r for r in quality.judge(docs_of(*rows), RULES).collect()}
    assert all(got[i].kept for i, _, _ in rows if i < 900) and got[900].kept and got[901].kept and got[909].kept
    assert got[901].class_distance is None
    assert not got[904].kept and not got[905].kept and not got[906].kept and not got[902].kept


def test_repeated_rows_count_each(spark, docs_of):
    rows = corpus()[:12] * 2 + [(None, "a b", None)]
    got = quality.judge(docs_of(*rows), RULES).collect()
    assert len(got) == 25 and sum(r.kept for r in got) == 24


def test_words_are_learned_from_every_text(spark):
    """Nine words of exactly a fifth of 3,000 texts each: a sample of them would miss some."""
    filler = " ".join(f"f{i}x" for i in range(10))
    rows = [(i, " ".join(f"{filler}{i} word{k}" if not k else f"word{k}" for k in range(9) if (i + k) % 5 == 0) or f"{filler}{i}", "en") for i in range(3000)]
    rows = [(i, t if len(t.split()) >= 10 else f"{filler}{i} {t}", lang) for i, t, lang in rows]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    words = quality.common_words(quality._rows(table), quality.Rules(top_words=30))["en"]
    assert {w for w in words if w.startswith("word")} == {f"word{k}" for k in range(9)}
