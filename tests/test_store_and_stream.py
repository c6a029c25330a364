import datetime as dt
import re
import json

import pytest
from parley import schemas
from parley.operators import summarise
from parley.plans import pipeline
from parley.sources import files, keyfilter
from parley.sources.store import Store, due_today, in_parts, latest_date
from parley.streaming import ingest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_text_and_matching import RUN, posts


@pytest.fixture
def store(spark, tmp_path):
    made = Store(spark, str(tmp_path / "store"))
    made.create_tables()
    made.create_tables()
    return made


def comments(spark, *ids, day=9):
    rows = [(i, "t", "s", dt.datetime(2024, 5, day, 8), "good PNC", "PNC", 1) for i in ids]
    return spark.createDataFrame(rows, schemas.COMMENTS)


def test_append_is_idempotent_and_dedups_inside_a_batch(spark, store):
    store.insert_new_comments(comments(spark, "a", "b", "a"))
    store.insert_new_comments(comments(spark, "b", "c"))
    store.insert_new_comments(comments(spark))
    assert sorted(r[0] for r in store.existing_ids("comments").collect()) == ["a", "b", "c"]


def test_append_matches_columns_by_name_without_case(spark, store):
    row = spark.createDataFrame([(1, "m", "k", 7, dt.date(2024, 5, 9), "s")], "Size bigint, MMR string, KeyBERT string, Topic int, Date date, Summary string")
    store.update_topic_summaries(row)
    got = store.read("topic_summaries", schemas.TOPIC_SUMMARIES).first()
    assert (got["topic"], got["mmr"], got["size"]) == (7, "m", 1)


def test_lookback_bound_is_inclusive(spark, store):
    store.insert_new_comments(comments(spark, "old", day=1).unionByName(comments(spark, "edge", day=3)).unionByName(comments(spark, "new")))
    got = store.recent_comments(dt.datetime(2024, 5, 10, 8), 7)
    assert sorted(r["comment_id"] for r in got.collect()) == ["edge", "new"]


def test_marks_and_gate(spark, store):
    assert store.last_run("x", RUN) == RUN - dt.timedelta(days=1)
    store.record_run("x", dt.datetime(2024, 5, 9, 9, 32, 48))
    store.record_run("x", dt.datetime(2024, 5, 8))
    assert store.last_run("x", RUN) == dt.datetime(2024, 5, 9, 9, 32, 48)
    empty = store.read("topic_summaries", schemas.TOPIC_SUMMARIES)
    assert latest_date(empty) is None and due_today(empty, RUN.date())


def test_extract_run_then_rerun(spark, store):
    for _ in range(2):
        pipeline.run_extract(store, posts(spark), ["PNC", "Citi"], RUN)
    assert sorted(r[0] for r in store.existing_ids("comments").collect()) == ["a", "e", "f"]
    assert store.existing_ids("sentiment").count() == 3
    assert store.last_run(pipeline.EXTRACT, RUN) == RUN - dt.timedelta(hours=1)


def test_stream_replay_adds_nothing(spark, store, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    rows = [json.loads(r) for r in posts(spark).toJSON().collect()]
    for name in ("one", "two"):
        (landing / f"{name}.json").write_text("\n".join(json.dumps(r) for r in rows))
    since = RUN - dt.timedelta(days=1)
    for checkpoint in ("c1", "c1", "c2"):
        stream = files.stream_landing(spark, str(landing), files_per_batch=1)
        ingest.ingest_posts(stream, ["PNC", "Citi"], store, since, RUN, str(tmp_path / checkpoint))
    assert sorted(r[0] for r in store.existing_ids("comments").collect()) == ["a", "e", "f"]
    assert store.existing_ids("sentiment").count() == 3
    batch = files.read_landing(spark, str(landing))
    assert batch.count() == 6


def test_daily_topics_once_a_day(spark, store):
    themes = ["PNC fees are bad and the fees rise.", "PNC app is great, the app works.", "Citi cards love cards."]
    rows = [(f"c{i}", "t", "s", dt.datetime(2024, 5, 9, i % 20, i % 60), f"{themes[i % 3]} Number {i}.", "PNC", 1) for i in range(60)]
    store.insert_new_comments(spark.createDataFrame(rows, schemas.COMMENTS))
    run = lambda: pipeline.run_daily_topics(store, RUN, k=3, min_cluster_size=5)
    assert run() is True and run() is False
    got = store.read("topic_summaries", schemas.TOPIC_SUMMARIES).collect()
    assert sum(r["size"] for r in got) <= 60 and all(r["summary"] and r["keybert"] and r["mmr"] for r in got)
    assert all(r["date"] == RUN.date() and 0 < len(r["summary"]) <= 512 for r in got)


def test_summary_rules():
    text = "The cat sat on the mat today. The cat sat on the mat again! A dog ran far away.\nThe cat is the cat."
    best = summarise.extract_sentences(text, min_words=5)
    assert best and all(s in text for s in best.split(". "))
    both = summarise.extract_sentences(text, min_words=40)
    assert not ("today" in both and "again" in both)
    assert summarise.extract_sentences("") == "" and len(summarise.extract_sentences("x" * 1024)) == 512
    long = " ".join(f"word{i}" for i in range(300))
    cut = summarise.extract_sentences(long)
    assert long.startswith(cut + " ") and 500 < len(cut) <= 512
    pair = [" ".join(f"{w}{i}" for i in range(30)) + "." for w in ("first", "second", "third")]
    whole = summarise.extract_sentences(" ".join(pair))
    assert len(whole) <= 512 and whole and all(s in pair for s in re.findall(r"[^.]+\.", whole.replace(". ", ".")))


def test_hot_topic_is_summarised_level_by_level(spark):
    rows = [(i, "hot", f"Sentence {i} tells of rates and fees. ") for i in range(900)] + [(1000, "small", "Only this one here.")]
    df = spark.createDataFrame(rows, "id bigint, topic string, t string")
    got = {r["topic"]: r["summary"] for r in summarise.summarise_topics(df, "topic", "id", "t").collect()}
    assert set(got) == {"hot", "small"} and got["small"] == "Only this one here." and 0 < len(got["hot"]) <= 512


def test_a_model_replaces_the_summariser(spark):
    from pyspark.ml.functions import predict_batch_udf

    shorten = predict_batch_udf(lambda: lambda texts: __import__("numpy").array([str(t)[:20] for t in texts], dtype=object), return_type=T.StringType(), batch_size=8)
    df = spark.createDataFrame([(i, "x", "abcdefghij" * 30) for i in range(20)], "id bigint, topic string, t string")
    assert summarise.summarise_topics(df, "topic", "id", "t", summariser=lambda c: shorten(c)).first()["summary"] == ("abcdefghij" * 2)


def test_late_rows_reach_the_store_in_any_batch_order(spark, tmp_path):
    """Four one-comment files, one per batch, the oldest last: all are stored, as by one batch read."""
    landing = str(tmp_path / "landing")
    rows = [(f"c{d}", f"2024-05-0{d} 10:00:00") for d in (8, 7, 3, 2)]
    for at, (key, when) in enumerate(rows):
        spark.createDataFrame([(key, "t", "s", when, "love Westpac", 1)], "comment_id string, post_title string, subreddit string, comment_date string, comment string, upvotes long").withColumn(
            "comment_date", F.col("comment_date").cast("timestamp")
        ).coalesce(1).write.mode("append").parquet(f"{landing}/{at}")
    schema = spark.read.parquet(f"{landing}/0").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{landing}/*")
    store = Store(spark, str(tmp_path / "store"))
    ingest.ingest_comments(stream, ["Westpac"], store, dt.datetime(2024, 1, 1), str(tmp_path / "checkpoint"))
    assert {r.comment_id for r in store.comments().collect()} == {"c8", "c7", "c3", "c2"}
    assert store.read("sentiment", schemas.SENTIMENT).count() == 4


def test_earlier_day_is_not_due_again_and_first_copy_wins(spark, tmp_path):
    summaries = spark.createDataFrame([(dt.date(2024, 5, 8),), (dt.date(2024, 5, 9),)], "date date")
    assert not due_today(summaries, dt.date(2024, 5, 8)) and due_today(summaries, dt.date(2024, 5, 7))
    for at, order in enumerate(([0, 1], [1, 0])):
        store = Store(spark, str(tmp_path / f"s{at}"))
        store.create_tables()
        rows = [("a", "t", "s", dt.datetime(2024, 5, 8, 1), "first", "p", 1), ("a", "t", "s", dt.datetime(2024, 5, 8, 2), "second", "p", 1)]
        schema = "comment_id string, post_title string, subreddit string, comment_date timestamp, comment string, matched_phrase string, upvotes long"
        store.insert_new_comments(spark.createDataFrame([rows[i] for i in order], schema))
        assert [r.comment for r in store.comments().collect()] == ["first"]


def test_a_key_that_returns_under_another_day_is_not_stored_again(spark, store):
    store.insert_new_comments(comments(spark, "a", "b", day=3).unionByName(comments(spark, "c", day=9)))
    undated = comments(spark, "n").withColumn("comment_date", F.lit(None).cast("timestamp"))
    store.insert_new_comments(undated)
    store.insert_new_comments(comments(spark, "a", "d", "n", day=8).unionByName(comments(spark, "c", day=1)))
    got = sorted((r["comment_id"], r["day"] and r["day"].day) for r in store.comments().collect())
    assert got == [("a", 3), ("b", 3), ("c", 9), ("d", 8), ("n", None)]
    scored = lambda day: spark.createDataFrame([("a", 0.5, "POSITIVE", dt.date(2024, 5, day))], Store.SENTIMENT_STORED)
    for day in (3, 8):
        store.update_sentiment(scored(day))
    assert [r["day"].day for r in store.read("sentiment", Store.SENTIMENT_STORED).collect()] == [3]


def test_key_filters_prune_the_days_that_are_read(spark, store):
    for day in range(1, 9):
        store.insert_new_comments(comments(spark, *(f"{day}-{i}" for i in range(400)), day=day))
    filters = store.key_filters("comments", "comment_id", Store.COMMENTS_STORED, "day")
    ask = lambda *ids: sorted(d.day for d in keyfilter.parts_that_may_hold(filters, comments(spark, *ids), "comment_id"))
    assert ask("3-7", "5-399") == [3, 5] and all(day in ask(*(f"{day}-{i}" for i in range(400))) for day in range(1, 9))
    strange = spark.range(20_000).select(F.concat(F.lit("x"), "id").alias("comment_id"))
    probed = filters.select(F.col("part").alias("day"), F.col("blocks")).distinct().collect()
    assert {r["blocks"] for r in probed} == {64}
    wrong = sum(len(keyfilter.parts_that_may_hold(filters, strange.where(F.col("comment_id") == f"x{i}"), "comment_id")) for i in range(5))
    assert wrong <= 2
    plan = in_parts(store.comments(), "day", [dt.date(2024, 5, 3), dt.date(2024, 5, 5)])
    assert len({f.split("day=")[1][:10] for f in plan.inputFiles()}) >= 2
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day", text)
    assert {r["day"].day for r in plan.select("day").distinct().collect()} == {3, 5}


def test_key_filters_are_made_for_a_store_that_has_none(spark, tmp_path):
    store = Store(spark, str(tmp_path / "old"))
    store.create_tables()
    store.append("comments", comments(spark, "a", day=2).withColumn("day", F.to_date("comment_date")), Store.COMMENTS_STORED, "day")
    store.insert_new_comments(comments(spark, "a", "b", day=7))
    assert sorted(r["comment_id"] for r in store.comments().collect()) == ["a", "b"]
