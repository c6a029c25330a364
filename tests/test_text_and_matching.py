import datetime as dt
import random
import re

from parley import schemas
from parley.functions import automaton, text
from parley.functions.patterns import alternation, leftmost_match
from parley.operators import chunks, keys, matching, recency, threads
from parley.sources import dictionary, files
from pyspark.sql import functions as F

CSV = """name,altname,abbreviation,ticker,altticker,notes
Citi,Citigroup,,,,
Westpac Banking Corporation, Westpac,,WBC,,
Allied Irish Bank (UK),,,AIBG.L,,
U.S. Bancorp,,USB,USB,,
NatWest,,,NWG,,
Royal Bank of Scotland,,RBS,NWG,,"renamed, see NatWest"

"""


def entries(spark, tmp_path):
    path = tmp_path / "firms.csv"
    path.write_text(CSV)
    return dictionary.read_dictionary(spark, str(path))


def phrase(spark, texts, terms, **options):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(leftmost_match(F.col("t"), alternation(terms, **options))).collect()]


def test_dictionary_rows_and_terms(spark, tmp_path):
    df = entries(spark, tmp_path)
    assert df.count() == 6 and df.where("altticker IS NULL").count() == 6
    patterns = {r[0] for r in dictionary.row_patterns(df).collect()}
    assert "Citi|Citigroup" in patterns and "Westpac Banking Corporation|Westpac|WBC" in patterns
    terms = [r[0] for r in dictionary.terms(dictionary.row_patterns(df)).collect()]
    assert sorted(terms).count("NWG") == 1 and "USB" in terms
    assert sorted(matching.term_list(dictionary.terms(dictionary.row_patterns(df)))) == sorted(terms)
    assert matching.term_list(dictionary.terms(dictionary.row_patterns(df)), limit=2) is None
    untrimmed = {r[0] for r in dictionary.row_patterns(df, trim=False).collect()}
    assert "Westpac Banking Corporation| Westpac|WBC" in untrimmed
    bounded = dictionary.bounded_patterns(dictionary.row_patterns(df)).where("pattern = 'Citi|Citigroup'").first()
    assert bounded["bounded"] == r"\bCiti\b|\bCitigroup\b"


def test_owner_mapping_is_one_to_many(spark, tmp_path):
    owners = dictionary.term_owners(entries(spark, tmp_path))
    found = spark.createDataFrame([(1, "nwg")], "id int, matched_phrase string")
    assert {r["owner"] for r in matching.map_to_owners(found, owners).collect()} == {"NatWest", "Royal Bank of Scotland"}


def test_leftmost_longest_and_boundaries(spark):
    terms = ["Westpac", "Westpac Banking Corporation", "MS", "U.S. Bancorp", "Allied Irish Bank (UK)"]
    got = phrase(
        spark,
        ["love Westpac Banking Corporation", "Westpac rocks", "ms paint", "éMS", "the U.S. Bancorp", "UXSX Bancorp",
         "Allied Irish Bank (UK) too", "Allied Irish Bank UK", "nothing"],
        terms,
    )
    assert got == ["Westpac Banking Corporation", "Westpac", "ms", None, "U.S. Bancorp", None, "Allied Irish Bank (UK)", None, None]
    assert phrase(spark, ["Allied Irish Bank UK", "UXSX Bancorp"], terms, literal=False) == ["Allied Irish Bank UK", "UXSX Bancorp"]
    assert phrase(spark, ["ms", "MS"], ["MS"], ignore_case=False) == [None, "MS"]


def test_all_matchers_agree(spark):
    terms = ["bank of america", "bank", "america", "pnc", "U.S. Bancorp", "Größe", "e.on", "!!", "(uk)"]
    texts = ["The Bank of America, PNC", "pnc bank", "banks", "of America the bank", "a u.s. BANCORP b", "xgröße GRÖSSE größe", "E.ON!!", "wow !!", "AIB (UK)", "bank  of america",
             "\u0130bank Bank", "\u212a e.on", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    listed = spark.createDataFrame([(t,) for t in [*terms, ""]], "term string")
    rows = lambda found: {r["id"]: r["matched_phrase"] for r in found.collect()}
    expected = rows(matching.mentions(df, "t", terms))
    assert expected[0] == "Bank of America" and expected[4] == "u.s. BANCORP" and expected[5] == "größe" and expected[6] == "E.ON" and 2 not in expected
    assert rows(matching.mentions_by_automaton(df, "t", terms)) == expected
    assert rows(matching.mentions_by_join(df, "t", listed)) == expected
    assert rows(matching.mentions(df, "t", listed)) == expected
    assert rows(matching.mentions(df, "t", listed.limit(0))) == {} == rows(matching.mentions_by_join(df, "t", listed.limit(0)))


def test_ten_thousand_punctuated_terms(spark, monkeypatch):
    """Terms that start alike, hold one another and end in marks: automaton, join and one regular expression find the same."""
    draw = random.Random(6)
    word = lambda: "".join(draw.choice("abé") for _ in range(draw.randint(1, 4)))
    made = lambda: draw.choice(["{} {}", "{}.{}", "{}&{}!", "({}) {}", "{}", "{}-{} {}", "{}'s {}"]).replace("{}", "\x00")
    fill = lambda t: "".join(word() if c == "\x00" else c for c in t)
    terms = sorted({fill(made()) for _ in range(30000)} - {""})[:10000]
    assert len(terms) == 10000
    texts = [" ".join(draw.choice([word(), word(), "zz", draw.choice(terms).upper()]) + draw.choice(["", "", "!", ","]) for _ in range(draw.randint(0, 30))) for _ in range(300)]
    texts += ["zz " * 50 for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    listed = spark.createDataFrame([(t,) for t in terms], "term string")
    rows = lambda found: {r["id"]: r["matched_phrase"] for r in found.collect()}
    wanted = sorted({automaton.fold(t) for t in terms}, key=lambda t: (-len(t), t))
    expected = {}
    for i, text in enumerate(texts):
        low = automaton.fold(text)
        hits = [(at, -len(t)) for t in wanted for at in [m.start() for m in re.finditer(re.escape(t), low)] if automaton.bounded(low, at, at + len(t))] if i < 60 else None
        if hits:
            expected[i] = text[min(hits)[0] : min(hits)[0] - min(hits)[1]]
    by_machine = rows(matching.mentions(df, "t", listed))
    assert {i: p for i, p in by_machine.items() if i < 60} == expected
    monkeypatch.setattr(matching, "AUTOMATON_CHARS", 1000)
    assert rows(matching.mentions(df, "t", listed)) == by_machine and len(by_machine) > 250


RUN = dt.datetime(2024, 5, 10, 12, 0, 0)


def epoch(at):
    return int(at.replace(tzinfo=dt.timezone.utc).timestamp())


def posts(spark):
    young, old = epoch(RUN - dt.timedelta(hours=2)), epoch(RUN - dt.timedelta(days=2))
    c = lambda i, body, hours: (i, body, epoch(RUN - dt.timedelta(hours=hours)), 3)
    rows = [
        ("stocks", "p1", "T1", young, [c("a", "PNC up", 1), c("b", "hm", 1), c("a", "PNC again", 1)]),
        ("stocks", "p2", "T2", old, [c("x", "PNC old post", 1)]),
        ("finance", "p3", "T3", young, [c("d", "pnc late", 30), c("e", "Citi fees", 1), c("f", "Citi!", 1)]),
    ]
    return spark.createDataFrame(rows, schemas.POSTS)


def test_extract_rules(spark):
    got = matching.extract_comments(posts(spark), ["PNC", "Citi"], RUN - dt.timedelta(hours=24), RUN)
    assert got.columns == ["subreddit", "post_title", "comment_id", "comment_date", "comment", "matched_phrase", "upvotes"]
    assert {r["comment_id"]: r["comment"] for r in got.collect()} == {"a": "PNC up", "e": "Citi fees", "f": "Citi!"}
    one = matching.extract_comments(posts(spark), ["PNC", "Citi"], RUN - dt.timedelta(hours=24), RUN, target=2)
    assert [r["comment_id"] for r in one.collect()] == ["e", "f"]


def test_clean_and_conform(spark):
    df = spark.createDataFrame([("1", r"\bMS\b + x")], "comment_id string, matched_phrase string")
    row = schemas.clean_comments(df).first()
    assert row["matched_phrase"] == "MS  x" and row["upvotes"] == 0 and row["subreddit"] == ""
    empty = spark.createDataFrame([], "comment_id string")
    assert set(schemas.COMMENTS.names) <= set(schemas.clean_comments(empty).columns)


def test_templates(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('"Love {}!",\n"Is {}, again, down?", \n\n"one {}","two {}"\n')
    got = {r[0] for r in dictionary.read_templates(spark, str(path)).collect()}
    assert got == {"Love {}!", "Is {}, again, down?", "one {}", "two {}"}


def test_csv_round_trip_and_pairs(spark, tmp_path):
    df = spark.createDataFrame([("2024-05-01T10:00:00", 'say "hi", {}')], "timestamp string, tweet_content string")
    files.write_csv(df, str(tmp_path / "out"))
    row = files.read_generated_posts(spark, str(tmp_path / "out")).first()
    assert row["tweet_content"] == 'say "hi", {}' and row["timestamp"] == dt.datetime(2024, 5, 1, 10)
    (tmp_path / "p.json").write_text('{"pair_id": 1, "reference": "a", "generated": "b"}\n')
    assert files.read_pairs(spark, str(tmp_path / "p.json")).first()["generated"] == "b"
    (tmp_path / "lex.txt").write_text("good\t1.9\t0.9\t[2, 1]\n:)\t2.0\t1\t[2]\n")
    assert {r[0]: r[1] for r in files.read_lexicon(spark, str(tmp_path / "lex.txt")).collect()} == {"good": 1.9, ":)": 2.0}


def test_ngrams_windows_sentences(spark):
    df = spark.createDataFrame([("aa bb cc dd ee",), ("",)], "t string")
    grams, none = [r[0] for r in df.select(text.ngrams(text.words(F.col("t")), 2, 3)).collect()]
    assert grams == ["aa bb", "bb cc", "cc dd", "dd ee", "aa bb cc", "bb cc dd", "cc dd ee"] and none == []
    wins = df.select(text.windows(text.words(F.col("t")), 3, 2)).first()[0]
    assert [w["items"] for w in wins] == [["aa", "bb", "cc"], ["cc", "dd", "ee"], ["ee"]]
    s = spark.createDataFrame([("One. Two!  Three\nfour v1.2",)], "t string").select(text.sentences(F.col("t"))).first()[0]
    assert s == ["One.", "Two!", "Three", "four v1.2"]


def test_joined_chunks_equal_joined_text(spark):
    texts = {"hot": ["é" * 70, "", "b" * 3, "c d", "x" * 200] * 40, "one": ["short"], "edge": ["y" * 63, "z"]}
    rows = [(t, i * 40_000, s) for t, parts in texts.items() for i, s in enumerate(parts)]
    df = spark.createDataFrame(rows, "topic string, ord bigint, text string").repartition(7)
    got = {}
    for r in sorted(chunks.joined_chunks(df, "topic", "ord", "text", width=64).collect(), key=lambda r: r["chunk_no"]):
        got.setdefault(r["topic"], []).append(r["chunk"])
    for topic, parts in texts.items():
        whole = " ".join(parts)
        assert got[topic] == [whole[i : i + 64] for i in range(0, len(whole), 64)]
    assert chunks.chunk_text(df.where("text = ''"), "ord", "text").isEmpty()


def test_threads_deep_and_broad(spark):
    rows = [("r", None)] + [(f"k{i}", "r") for i in range(300)] + [("d0", "r")] + [(f"d{i}", f"d{i - 1}") for i in range(1, 40)]
    rows += [("orphan", "gone")]
    got = {r["id"]: (r["root"], r["depth"]) for r in threads.flatten_threads(spark.createDataFrame(rows, "id string, parent_id string")).collect()}
    assert got["r"] == ("r", 0) and got["k7"] == ("r", 1) and got["d39"] == ("r", 40) and got["orphan"] == ("orphan", 0)


def test_top_rows_are_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = keys.top_per_group(df, ["k"], ["id"], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_time_formats(spark):
    row = spark.range(1).select(
        recency.stamp(recency.from_epoch(F.lit(0))).alias("s"),
        recency.iso(recency.parse_stamp(F.lit(" 2024-05-09 09:32:48 "))).alias("i"),
    ).first()
    assert row["s"] == "1970-01-01 00:00:00" and row["i"] == "2024-05-09T09:32:48"


def test_observed_counters(spark):
    df, seen = recency.observed(spark.range(10), "run", F.col("id") < 4)
    df.collect()
    assert seen.get == {"checked": 10, "collected": 4}


def test_dense_order_keeps_every_row(spark):
    rows = [(5 if i % 3 else i, f"id{i:04d}") for i in range(500)]
    df = spark.createDataFrame(rows, "at int, id string").repartition(6)
    got = keys.dense_order(df, ["at", "id"]).orderBy("ord").collect()
    assert [r["ord"] for r in got] == list(range(500))
    assert [(r["at"], r["id"]) for r in got] == sorted(rows)
