import math
import random
import re

import numpy as np
import pytest
from parley.operators import evaluation, sentiment
from pyspark.sql import functions as F


def compound(v):
    return round(v / math.sqrt(v * v + 15), 4)


CASES = {
    "": 0.0,
    "the table": 0.0,
    "a good day": compound(1.9),
    "not a good day": compound(1.9 * -0.74),
    "never so good": compound((1.9 + 0.293) * 1.5),
    "it wasn't good": compound(1.9 * -0.74),
    "very good": compound(1.9 + 0.293),
    "a barely good one": compound(1.9 - 0.293),
    "extremely very good": compound(1.9 + 0.293 + 0.293 * 0.95),
    "good!!!!!!": 0.0,
    "a GOOD day": compound(1.9 + 0.733),
    "GOOD DAY": compound(1.9),
    "very BAD day": compound(-2.5 - 0.733 - 0.293),
    "good!": compound(1.9 + 0.292),
    "good!!! !!!": compound(1.9 + 4 * 0.292),
    "good??": compound(1.9 + 2 * 0.18),
    "bad??? ?": compound(-2.5 - 0.96),
    "good but bad": compound(1.9 * 0.5 - 2.5 * 1.5),
    "least good": compound(1.9 * -0.74),
    "at least good": compound(1.9),
    "kind of good": compound(1.9),
}


def test_rules(spark):
    rows = list(CASES)
    df = spark.createDataFrame(list(enumerate(rows)) + [(99, None)], "id int, t string")
    got = {r["id"]: r for r in sentiment.sentiment_scores(df, "id", "t").collect()}
    assert {rows[i]: got[i]["compound"] for i in range(len(rows))} == CASES
    assert got[99]["sentiment"] == "NEUTRAL" and got[0]["neu"] == 0.0
    assert got[2]["pos"] == round(2.9 / (2.9 + 1), 3)


def test_large_lexicon_takes_the_join(spark, monkeypatch):
    monkeypatch.setattr(sentiment, "PROBE_LIMIT", 1)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "id int, t string")
    got = {r["id"]: r["compound"] for r in sentiment.sentiment_scores(df, "id", "t").collect()}
    assert [got[i] for i in range(len(CASES))] == list(CASES.values())


def test_with_sentiment_keeps_columns(spark):
    df = spark.createDataFrame([(1, "good", "x")], "id int, t string, other string")
    row = sentiment.with_sentiment(df, "id", "t").first()
    assert row["other"] == "x" and row["sentiment_scores"]["compound"] == row["compound"]


def test_label_bounds(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.0499,)], "c double")
    assert [r[0] for r in df.select(sentiment.label(F.col("c"))).collect()] == ["POSITIVE", "NEGATIVE", "NEUTRAL"]


def labels(spark):
    true = ["positive", "negative", "neutral", "positive", "negative"]
    guess = ["positive", "neutral", "neutral", "positive", "negative"]
    return spark.createDataFrame(list(zip(true, guess)), "t string, p string")


def test_class_metrics_golden(spark):
    rows = evaluation.class_metrics(labels(spark), "t", "p").orderBy("position").collect()
    assert [r["precision"] for r in rows] == [1.0, 0.5, 1.0]
    assert [r["recall"] for r in rows] == [0.5, 1.0, 1.0]
    assert [round(r["f1"], 4) for r in rows] == [0.6667, 0.6667, 1.0]


def test_report_golden(spark):
    rows = {r["label"]: r for r in evaluation.classification_report(labels(spark), "t", "p").collect()}
    assert rows["accuracy"]["f1"] == pytest.approx(0.8)
    assert [round(rows["macro avg"][c], 4) for c in ("precision", "recall", "f1")] == [0.8333, 0.8333, 0.7778]
    assert [round(rows["weighted avg"][c], 4) for c in ("precision", "recall", "f1")] == [0.9, 0.8, 0.8]


def pair(spark):
    return spark.createDataFrame(
        [(1, "This is the human reference summary.", "This is the generated summary.")],
        "pair_id int, reference string, generated string",
    )


def test_summary_goldens(spark):
    row = evaluation.evaluate_summaries(pair(spark), ["pair_id"]).first()
    want = {"rouge1": (0.8, 0.6667, 0.7273), "rouge2": (0.5, 0.4, 0.4444), "rougel": (0.8, 0.6667, 0.7273)}
    for name, values in want.items():
        assert tuple(round(row[f"{name}_{c}"], 4) for c in ("p", "r", "f")) == values
    assert round(row["bleu"], 3) == 32.159 and round(row["readability"], 2) == 32.56


def test_rouge_l_against_plain_dynamic_programme(spark):
    import random

    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices("abcde", k=rng.randint(0, 90))), " ".join(rng.choices("abcde", k=rng.randint(0, 90)))) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, reference string, generated string")
    got = {r["id"]: r["p"] for r in evaluation.rouge_l(df).collect()}
    for i, a, b in rows:
        a, b = a.split(), b.split()
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for x in range(len(a)):
            for y in range(len(b)):
                table[x + 1][y + 1] = table[x][y] + 1 if a[x] == b[y] else max(table[x][y + 1], table[x + 1][y])
        assert got[i] == pytest.approx(table[-1][-1] / len(b) if b else 0.0)


def test_long_texts_without_python_rows(spark):
    """Texts of thousands of words: equal to one another but for a cut, and with one word throughout."""
    words = [f"w{i * i % 997}" for i in range(4000)]
    rows = [(1, " ".join(words), " ".join(words[:1500] + words[1700:])), (2, "a " * 3000, "a " * 2000), (3, "", "a"), (4, "a", None)]
    scored = evaluation.rouge_l(spark.createDataFrame(rows, "id int, reference string, generated string"))
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    got = {r["id"]: r["p"] for r in scored.collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 0.0, 4: 0.0}


@pytest.mark.parametrize("block", [3, 1024])
def test_token_match_equals_a_plain_loop(spark, block):
    import random

    import numpy as np

    rng = random.Random(5)
    known = {w: [rng.uniform(-1, 1) for _ in range(4)] for w in "abcdefghij"}
    rows = [(i, " ".join(rng.choices("abcdefghijkl", k=30)), " ".join(rng.choices("abcdefghijkl", k=20))) for i in range(8)] + [(8, "a b", "k l"), (9, "k", "l"), (10, None, "a")]
    pairs = spark.createDataFrame(rows, "id int, reference string, generated string")
    vectors = spark.createDataFrame(list(known.items()), "token string, vector array<double>")
    got = {r["id"]: (r["precision"], r["recall"]) for r in evaluation.token_match(pairs, ["id"], vectors, block=block).collect()}
    likeness = lambda v, w: np.dot(known[v], known[w]) / np.linalg.norm(known[v]) / np.linalg.norm(known[w])
    assert set(got) == {*range(9), 10}
    for i, a, b in rows:
        r, g = ([w for w in (t or "").split() if w in known] for t in (a, b))
        if r and g:
            assert got[i] == pytest.approx((np.mean([max(likeness(w, v) for v in r) for w in g]), np.mean([max(likeness(w, v) for v in g) for w in r])))
        elif r or g:
            assert got[i] == (0.0, 0.0)


def test_bleu_counts_are_not_shuffled_after_the_join(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a b"), (1, 1, "assistant", "a c")], "conv_id int, turn int, role string, text string")
    pairs = evaluation.dialogue_pairs(turns).hint("merge")
    plan = evaluation.corpus_bleu(pairs, ["conv_id", "turn"])._jdf.queryExecution().executedPlan().toString()
    assert "gram" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


def test_bleu_of_single_pairs_makes_no_gram_rows_and_pools_repeated_keys(spark):
    draw = random.Random(8)
    sentence = lambda: " ".join(draw.choice(["a", "b", "c", "d.", "e,"]) for _ in range(draw.randint(0, 9)))
    rows = [(i // 2 if i < 8 else i, sentence(), sentence()) for i in range(30)] + [(40, None, "a b"), (41, "a b", None)]
    pairs = spark.createDataFrame(rows, "id int, reference string, generated string")
    made, given = {}, {}
    for i, r, g in rows:
        for box, t in ((made, g), (given, r)):
            words = re.findall(r"\w+|[^\w\s]", t or "")
            for n in range(1, 5):
                for k in range(len(words) - n + 1):
                    box[(i, *words[k : k + n])] = box.get((i, *words[k : k + n]), 0) + 1
    total = [sum(v for k, v in made.items() if len(k) == n + 1) for n in range(1, 5)]
    hits = [sum(min(v, given.get(k, 0)) for k, v in made.items() if len(k) == n + 1) for n in range(1, 5)]
    length, ref = total[0], sum(v for k, v in given.items() if len(k) == 2)
    assert min(hits) > 0
    want = 100 * min(1.0, math.exp(1 - ref / length)) * math.exp(sum(math.log(h / t) for h, t in zip(hits, total)) / 4)
    scored = evaluation.corpus_bleu(pairs, ["id"])
    assert scored.first()["bleu"] == pytest.approx(want)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "(rows#" in plan


@pytest.mark.parametrize("small", [True, False])
def test_token_match_tasks_grow_with_the_texts(spark, monkeypatch, small):
    """A task holds the words of a bounded part of the pairs, also of those that share a key, whichever way vectors are met."""
    draw = np.random.default_rng(3)
    word = [f"w{i:03d}" for i in range(200)]
    text = lambda n: " ".join(draw.choice(word, n))
    rows = [(i if i < 60 else 7, text(20), text(15)) for i in range(120)] + [(None, text(5), ""), (300, text(5), ""), (301, "zz", "yy")]
    pairs = spark.createDataFrame(rows, "id int, reference string, generated string")
    vectors = spark.createDataFrame([(w, draw.normal(size=4).tolist()) for w in word], "token string, vector array<double>")
    want = {r["id"]: (r["precision"], r["recall"]) for r in evaluation.token_match(pairs, ["id"], vectors).collect()}
    written, write = [], evaluation.materialise
    monkeypatch.setattr(evaluation, "materialise", lambda df, label: written.append(df) or write(df, label))
    if not small:
        monkeypatch.setattr(evaluation, "small_side", lambda df: df)
    got = {r["id"]: (r["precision"], r["recall"]) for r in evaluation.token_match(pairs, ["id"], vectors, chars=500).collect()}
    assert set(got) == set(want) == {None, 300, *range(60)} and all(got[k] == pytest.approx(want[k]) for k in want)
    parts = written[0].groupBy(F.spark_partition_id()).count().collect()
    words = written[0].count()
    assert len(parts) >= 30 and max(r["count"] for r in parts) < words / 8
