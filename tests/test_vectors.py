import itertools
import random

import numpy as np
import pytest
from parley.operators import chunks, coherence, components, density, distribution, embedding, generate, keys, neighbour_index, neighbours, representation, terms
from parley.plans import topic_model
from pyspark.sql import functions as F


def vectors(n=240, dims=6, seed=1):
    """A third of the rows are copies of one vector, some others lie close to each other."""
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, dims))
    m[: n // 3] = m[0]
    m[n // 3 : n // 2] = m[n // 3] + 1e-3 * rng.normal(size=(n // 2 - n // 3, dims))
    return m


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_neighbours_against_brute_force(spark, monkeypatch, metric):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    m = vectors()
    df = spark.createDataFrame([(i * 7, v.tolist()) for i, v in enumerate(m)], "id bigint, v array<double>")
    got = {}
    for r in neighbours.nearest_neighbours(df, "id", "v", 5, metric).collect():
        got.setdefault(r["id"], {})[r["rank"]] = (r["neighbour"], r["distance"])
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    d = 1 - u @ u.T if metric == "cosine" else np.linalg.norm(m[:, None] - m[None], axis=2)
    for i in range(len(m)):
        want = np.sort(np.delete(d[i], i))[:5]
        assert [got[i * 7][k][1] for k in range(1, 6)] == pytest.approx(want.tolist(), abs=1e-7)
        assert len({got[i * 7][k][0] for k in range(1, 6)} - {i * 7}) == 5
    copies = sorted(i * 7 for i in range(len(m) // 3))
    assert [got[copies[20]][k][0] for k in range(1, 6)] == copies[:5]


def test_components_random_and_chain(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(35)]
    parent = {n: n for n in range(170)}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    nodes = spark.range(170).withColumnRenamed("id", "node")
    got = components.connected_components(nodes, spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r["node"]: r["component"] for r in got.collect()} == {n: find(n) for n in range(170)}


def plain_density(m, radius, min_points, smallest, k):
    """DBSCAN* over the k nearest of every point, by a plain search."""
    d = np.round(np.linalg.norm(m[:, None] - m[None], axis=2), 9)
    order = [sorted((x, j) for j, x in enumerate(row) if j != i)[:k] for i, row in enumerate(d)]
    core = [o[min_points - 1][0] for o in order]
    links = {i: set() for i in range(len(m))}
    for i, near in enumerate(order):
        for x, j in near:
            if max(x, core[i], core[j]) <= radius:
                links[i].add(j)
                links[j].add(i)
    label, groups = {}, []
    for i in range(len(m)):
        if i not in label and links[i]:
            todo, group = [i], {i}
            while todo:
                for j in links[todo.pop()] - group:
                    group.add(j)
                    todo.append(j)
            label.update(dict.fromkeys(group, len(groups)))
            groups.append(group)
    kept = sorted((g for g in groups if len(g) >= smallest), key=lambda g: (-len(g), min(g)))
    return {i: next((t for t, g in enumerate(kept) if i in g), -1) for i in range(len(m))}


def test_density_of_whole_vectors_against_a_plain_search(spark):
    """Blobs in 16 dimensions, one with a third of the points as copies, a bridge of sparse points and outliers."""
    rng = np.random.default_rng(2)
    centres = 4 * rng.normal(size=(4, 16))
    m = np.concatenate([c + 0.15 * rng.normal(size=(n, 16)) for c, n in zip(centres, (70, 40, 25, 7))] + [6 * rng.normal(size=(15, 16))])
    m = np.concatenate([m, np.repeat(m[:1], 80, axis=0), np.linspace(centres[0], centres[1], 12)])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(m)], "id bigint, p array<double>")
    near = keys.materialise(neighbours.nearest_neighbours(df, "id", "p", 8, "euclidean"), "near")
    for radius, smallest in ((0.9, 10), (0.9, 5), (3.0, 10)):
        got = {r["id"]: r["topic"] for r in density.density_clusters(df, near, "id", radius, 5, smallest).collect()}
        assert got == plain_density(m, radius, 5, smallest, 8)
    assert {r["topic"] for r in density.density_clusters(df, near.limit(0), "id", 1.0).collect()} == {-1}


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_neighbour_index_recall(spark, metric):
    """At least nine in ten of the true neighbours, for clustered and for spread vectors, with a third of all rows near one place."""
    rng = np.random.default_rng(8)
    clustered = rng.normal(size=(30, 24))[rng.integers(0, 30, 900)] + 0.3 * rng.normal(size=(900, 24))
    crowd = clustered[0] + 0.01 * rng.normal(size=(600, 24))
    m = np.concatenate([clustered, crowd, rng.normal(size=(250, 24)), np.repeat(clustered[5:6], 40, axis=0)])
    df = spark.createDataFrame([(3 * i, v.tolist()) for i, v in enumerate(m)] + [(-1, None)], "id bigint, v array<double>")
    got = {}
    for r in neighbour_index.approximate_neighbours(df, "id", "v", 10, metric, block=128).collect():
        got.setdefault(r["id"], {})[r["rank"]] = (r["neighbour"], r["distance"])
    u = m / np.linalg.norm(m, axis=1, keepdims=True) if metric == "cosine" else m
    d = 1 - u @ u.T if metric == "cosine" else np.linalg.norm(u[:, None] - u[None], axis=2)
    np.fill_diagonal(d, np.inf)
    assert set(got) == {3 * i for i in range(len(m))} and all(sorted(x) == list(range(1, 11)) for x in got.values())
    found = 0
    for i, row in enumerate(d):
        cut = np.partition(row, 9)[9] + 1e-8
        found += sum(d[i, n // 3] <= cut for n, _ in got[3 * i].values())
        assert all(abs(d[i, n // 3] - x) < 1e-6 for n, x in got[3 * i].values())
    assert found >= 0.9 * 10 * len(m)


@pytest.mark.parametrize("pool", [1, 1000])
def test_mmr_against_plain_loop(spark, pool):
    """Also with a pool that leaves candidates out at first, so that it has to grow."""
    rng = np.random.default_rng(4)
    m, centre = rng.normal(size=(25, 4)), rng.normal(size=4)
    cand = spark.createDataFrame([(1, f"t{i:02d}", v.tolist()) for i, v in enumerate(m)], "topic int, term string, vector array<double>")
    topics = spark.createDataFrame([(1, centre.tolist())], "topic int, centroid array<double>")
    got = [r["term"] for r in representation.diverse_pick(cand, topics, k=6, pool=pool).orderBy("rank").collect()]
    u, c = m / np.linalg.norm(m, axis=1, keepdims=True), centre / np.linalg.norm(centre)
    taken = [int((u @ c).argmax())]
    while len(taken) < 6:
        rest = [i for i in range(25) if i not in taken]
        taken.append(max(rest, key=lambda i: 0.7 * (u[i] @ c) - 0.3 * max(u[i] @ u[j] for j in taken)))
    assert got == [f"t{i:02d}" for i in taken]


def test_sparse_candidates_equal_arrays_in_a_bounded_pool(spark, monkeypatch):
    """Sparse vectors give the picks of arrays and of a plain loop, many equal scores included, and a pool grows by ``pool`` rows ``k`` times at most."""
    words = ["cat", "dog", "owl", "fox", "hen"]
    names = sorted({" ".join(p) for n in (1, 2, 3) for p in itertools.product(words, repeat=n)})
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(names + ["cat owl", "owl fox fox", "plain sea"])], "id int, t string")
    arrays, fitted = embedding.embed(docs, "id", "t")
    cand = spark.createDataFrame([(7, w) for w in names], "topic int, term string").select(F.struct("topic", "term").alias("key"), "term")
    form = lambda sparse: embedding.embed(cand, "key", "term", fitted=fitted, sparse=sparse)[0].select("key.*", F.col("embedding").alias("vector"))
    topics = representation.centroids(arrays.withColumn("topic", F.lit(7)), "topic", "embedding").localCheckpoint()
    held, greedy = [], representation._greedy
    monkeypatch.setattr(representation, "_greedy", lambda pool, *a: held.append(pool.count()) or greedy(pool, *a))
    picks = lambda sparse: [r["term"] for r in representation.diverse_pick(form(sparse), topics, k=5, pool=2).orderBy("rank").collect()]
    closest = lambda sparse: [(r["term"], r["similarity"]) for r in representation.rerank(form(sparse), topics, k=40).orderBy("rank").collect()]

    rows = {r["term"]: np.array(r["vector"], float) for r in form(False).collect()}
    u = {w: v / np.linalg.norm(v) for w, v in rows.items()}
    c = np.array(topics.first()["centroid"])
    near = {w: round(float(v @ c / np.linalg.norm(c)), 9) for w, v in u.items()}
    taken = [min(names, key=lambda w: (-near[w], w))]
    while len(taken) < 5:
        score = lambda w: round(0.7 * near[w] - 0.3 * max(round(float(u[w] @ u[t]), 9) for t in taken), 9)
        taken.append(min((w for w in names if w not in taken), key=lambda w: (-score(w), -near[w], w)))
    assert picks(True) == picks(False) == taken and max(held) <= 5 + 5 * 2 and len(held) <= 2 * 6
    assert closest(True) == closest(False) and len(closest(True)) == 40


def test_membership_rows_sum_to_one(spark):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors(30, 3))], "id int, v array<double>")
    centres = spark.createDataFrame([(0, [0.0, 0.0, 0.0]), (1, [1.0, 1.0, 1.0])], "topic int, centroid array<double>")
    sums = representation.membership(df, "id", "v", centres).groupBy("id").agg(F.sum("probability").alias("s"), F.count("*").alias("n"))
    assert all(abs(r["s"] - 1) < 1e-9 and r["n"] == 2 for r in sums.collect())


TEXTS = {0: "cats purr and cats sleep near warm cats", 1: "dogs bark while dogs run with happy dogs", 2: "rates rise as banks lift rates and fees"}


def corpus(spark, n=90):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.sample(TEXTS[i % 3].split(), 7))) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, t string")


@pytest.fixture
def many_parts(spark):
    """Range partitions stay apart on little data."""
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def sparse_corpus(spark, texts):
    """Two topics, the ids of one spread over the whole range of a long."""
    draw = random.Random(3)
    ids = sorted(draw.randrange(-(2**62), 2**62) for _ in texts)
    rows = [("x", i, s) for i, s in zip(ids, texts)] + [("y", i, s) for i, s in enumerate(texts)]
    random.Random(4).shuffle(rows)
    return spark.createDataFrame(rows, "topic string, id bigint, t string").repartition(5)


def test_neighbours_send_a_row_once_a_block(spark, monkeypatch):
    """Vectors that all lie far apart: copies of a row follow the blocks, not the pivots."""
    m = np.random.default_rng(5).normal(size=(400, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id bigint, v array<double>")
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    sizes, whole = [], neighbours.top_per_group

    def noted(found, keys, order, k, *name):
        if keys == ["vid"] and "distance" in found.columns:
            sizes.append(len(found.collect()))
        return whole(found, keys, order, k, *name)

    monkeypatch.setattr(neighbours, "top_per_group", noted)
    got = neighbours.nearest_neighbours(df, "id", "v", 5, "euclidean").collect()
    want = np.argsort(np.linalg.norm(m[:, None] - m[None], axis=2) + np.diag([9e9] * 400), axis=1)[:, :5]
    assert [r["neighbour"] for r in sorted(got, key=lambda r: (r["id"], r["rank"]))] == want.ravel().tolist()
    assert sizes[0] <= 400 * 6 * 8


def test_border_ngrams_equal_joined_text(spark, many_parts):
    texts = ["aa bb cc", "", "dd", "ee", "", "ff gg", "hh", "ii jj kk ll"] * 6
    words = " ".join(texts).split()
    want = {}
    for n in (1, 2, 3):
        for i in range(len(words) - n + 1):
            gram = " ".join(words[i : i + n])
            want[gram] = want.get(gram, 0) + 1
    got = terms.term_counts(sparse_corpus(spark, texts), "topic", "id", "t", stop_words=[]).collect()
    for topic in "xy":
        assert {r["term"]: r["tf"] for r in got if r["topic"] == topic} == want


@pytest.mark.parametrize("low, high", [(1, 1), (2, 2), (2, 4), (3, 4), (1, 5)])
def test_ngrams_of_any_length_equal_joined_text(spark, many_parts, low, high):
    texts = ["aa bb aa bb cc", "", "aa", "bb", "", "aa bb", "cc", "aa bb cc dd aa bb"] * 4
    words = " ".join(texts).split()
    want = {}
    for n in range(low, high + 1):
        for i in range(len(words) - n + 1):
            want[gram] = want.get(gram := " ".join(words[i : i + n]), 0) + 1
    got = terms.term_counts(sparse_corpus(spark, texts), "topic", "id", "t", low, high, stop_words=[]).collect()
    for topic in "xy":
        assert {r["term"]: r["tf"] for r in got if r["topic"] == topic} == want


def test_long_terms_are_shuffled_once(spark):
    """Counts, frequencies and products of a term's topics all happen where its first two words were sent."""
    weights = terms.corpus_weights(corpus(spark).withColumn("topic", F.col("id") % 3), "topic", "id", "t")
    plan = weights.select("topic", "term", "weight")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("term#" in line for line in exchanges)
    assert sum("anchor#" in line and "topic#" not in line for line in exchanges) == 1


def test_tagged_terms_against_a_plain_loop(spark):
    rows = [("x", "aa", 5.0), ("x", "aa bb", 4.0), ("x", "aa cc bb", 9.0), ("x", "bb aa aa", 3.0), ("y", "cc", 7.0), ("y", "bb", 1.0)]
    weights = spark.createDataFrame(rows, "topic string, term string, weight double")
    tags = spark.createDataFrame([("aa", "N"), ("bb", "N"), ("bb", "N"), ("cc", "V")], "token string, tag string")
    found = terms.tagged_terms(weights, tags, ["N"])
    assert sorted((r["topic"], r["term"], r["rank"]) for r in found.collect()) == [("x", "aa", 1), ("x", "aa bb", 2), ("x", "bb aa aa", 3), ("y", "bb", 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any("token" in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)


def test_chunks_of_sparse_ids_equal_joined_text(spark, many_parts):
    draw = random.Random(5)
    texts = ["".join(draw.choice("abc ") for _ in range(draw.choice([0, 1, 5, 40]))) for _ in range(120)]
    got = chunks.joined_chunks(sparse_corpus(spark, texts), "topic", "id", "t", width=16).collect()
    whole = " ".join(texts)
    for topic in "xy":
        pieces = [r["chunk"] for r in sorted((r for r in got if r["topic"] == topic), key=lambda r: r["chunk_no"])]
        assert "".join(pieces) == whole and all(len(p) == 16 for p in pieces[:-1])


def test_parts_are_few_and_short(spark, many_parts):
    """The windows of a prefix scan see a partition's rows, or one row per partition; a topic that holds all rows is cut."""
    df = sparse_corpus(spark, ["a"] * 700).where("topic = 'x'")
    parts = keys.range_parts(df, ["topic", "id"]).groupBy("part").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b"))
    rows = sorted(parts.collect(), key=lambda r: r["part"])
    assert len(rows) == 7 and max(r["n"] for r in rows) < 250 and all(x["b"] < y["a"] for x, y in zip(rows, rows[1:]))


def test_topic_model_invariants(spark):
    model = topic_model.fit_topics(corpus(spark), "id", "t", k=4, min_cluster_size=12)
    sizes = {r["topic"]: r["count"] for r in model.assigned.groupBy("topic").count().collect()}
    assert sum(sizes.values()) == 90
    kept = sorted(t for t in sizes if t >= 0)
    assert kept == list(range(len(kept))) and [sizes[t] for t in kept] == sorted((sizes[t] for t in kept), reverse=True)
    assert all(sizes[t] >= 12 for t in kept)
    info = {r["topic"]: r for r in model.info.collect()}
    assert set(info) == set(sizes) and all(info[t]["size"] == sizes[t] for t in sizes)
    assert all(info[t]["name"].startswith(f"{t}_") and len(info[t]["keybert"]) and len(info[t]["mmr"]) for t in info)
    assert all(len(info[t]["representative_docs"]) <= 3 for t in info)
    again = topic_model.fit_topics(corpus(spark), "id", "t", k=4, min_cluster_size=12)
    assert sorted(again.assigned.collect()) == sorted(model.assigned.collect())


def test_distribution_of_a_pure_text(spark):
    df = corpus(spark).withColumn("topic", F.col("id") % 3)
    weights = terms.term_weights(terms.term_counts(df, "topic", "id", "t"))
    tokens = terms.topic_tokens(df, "topic", "id", "t")
    shares, words = distribution.distributions(tokens, weights)
    best = {}
    for r in shares.collect():
        best.setdefault(r["ord"], []).append((r["share"], r["topic"]))
    assert all(max(v)[1] == i % 3 and abs(sum(s for s, _ in v) - 1) < 1e-9 for i, v in best.items())
    assert words.where("score <= 0").isEmpty()


def test_terms_meet_texts_with_plain_numbers_of_their_topics(spark):
    """What comes back to a text with every n-gram are two lists of numbers, the counts adding up to the term's frequency."""
    df = corpus(spark).withColumn("topic", F.col("id") % 3)
    weights = terms.term_weights(terms.term_counts(df, "topic", "id", "t"))
    numbers = distribution.number_topics(weights)
    met = distribution.term_topics(weights, numbers)
    assert dict(met.dtypes) == {"term": "string", "idf": "double", "nrs": "array<int>", "tfs": "array<bigint>"}
    of = {r["topic"]: r["nr"] for r in numbers.collect()}
    want = {}
    for r in weights.collect():
        want.setdefault(r["term"], set()).add((of[r["topic"]], r["tf"]))
    assert {r["term"]: set(zip(r["nrs"], r["tfs"])) for r in met.collect()} == want


def test_window_counts_against_brute_force(spark):
    rng = random.Random(11)
    docs = [[rng.choice("abcdefgh") * 2 for _ in range(rng.randint(1, 40))] for _ in range(30)]
    tokens = spark.createDataFrame(list(enumerate(docs)), "ord int, t array<string>")
    grid = [(a * 2, b * 2) for a in "abc" for b in "abc" if a <= b]
    got = {(r["a"], r["b"]): r["n"] for r in coherence.window_counts(tokens, spark.createDataFrame(grid, "a string, b string"), width=7).collect()}
    for a, b in grid:
        want = sum(a in (w := d[s : s + 7]) and b in w for d in docs for s in range(max(len(d) - 7, 0) + 1))
        assert got[(a, b)] == want


def test_embedding_with_a_model_runs_in_batches(spark):
    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts], dtype=np.float32)

    df = spark.createDataFrame([(1, "ab"), (2, "abcd")], "id int, t string")
    got = {r["id"]: r["embedding"] for r in embedding.embed_with_model(df, "id", "t", load).collect()}
    assert got == {1: [2.0, 1.0], 2: [4.0, 1.0]}


def test_templates_are_filled_by_seed(spark):
    firms = generate.numbered(spark.createDataFrame([("A",), ("B",), ("C",)], "firm string"), "firm")
    templates = generate.numbered(spark.createDataFrame([("x {}",), ("{} y",)], "template string"), "template")
    posts = spark.range(200).withColumnRenamed("id", "post_id")
    make = lambda seed: sorted(map(tuple, generate.fill_templates(posts, "post_id", firms, templates, seed=seed).select("post_id", "content").collect()))
    first = make(1)
    assert first == make(1) != make(2) and len(first) == 200
    assert {c for _, c in first} == {f"x {f}" for f in "ABC"} | {f"{f} y" for f in "ABC"}


def test_recent_topics_without_example_texts(spark):
    import datetime as dt

    run = dt.datetime(2024, 5, 10)
    rows = [(run - dt.timedelta(days=i % 10), TEXTS[i % 3]) for i in range(60)]
    posts = spark.createDataFrame(rows, "timestamp timestamp, tweet_content string")
    info = topic_model.recent_topics(posts, "tweet_content", 7, run, k=3, min_cluster_size=2)
    assert "representative_docs" not in info.columns and {"keybert", "mmr", "name"} <= set(info.columns)
    assert info.agg(F.sum("size")).first()[0] == 48


def test_term_vectors_are_sparse_and_not_shuffled(spark, monkeypatch):
    """A term's vector has as many numbers as words, each distinct term is embedded once, where its rows were written."""
    written, write = {}, topic_model.materialise
    monkeypatch.setattr(topic_model, "materialise", lambda df, label: written.setdefault(label, (df, write(df, label)))[1])
    model = topic_model.fit_topics(corpus(spark), "id", "t", k=4, min_cluster_size=12)
    plan, table = written["term-vectors"]
    rows = table.collect()
    assert all(1 <= len(r["vector"]["values"]) == len(r["vector"]["indices"]) <= 3 for r in rows)
    assert sorted((r["topic"], r["term"]) for r in rows) == sorted((r["topic"], r["term"]) for r in model.weights.collect())
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    assert "topics" not in model.weights.columns
