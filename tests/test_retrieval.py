"""Lexical, vector and hybrid search against brute force, and what the plans and the pruning do."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pressroom.operators import hybrid, lexical, vectors


def clustered(n=900, d=12, groups=30, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (groups, d))
    return [(int(i), [float(x) for x in centres[i % groups] + rng.normal(0, 0.08, d)]) for i in range(n)]


ODD = [(5000, None), (5001, [0.0] * 12), (5002, [1.0, None] + [0.0] * 10), (5003, [float("nan")] * 12), (5004, [float("inf")] + [0.0] * 11), (5005, [1.0, 2.0]), (5006, [2.0, 1.0]), (5007, [])]
TWINS = [(6000 + i, [1.0] * 12) for i in range(40)]  # equal vectors: ties by id


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def nearest(rows, queries, k):
    out = {}
    for q, v in queries:
        if usable(v):
            scored = [(-round(float(np.dot(v, w)) / (np.linalg.norm(v) * np.linalg.norm(w)), 6), i) for i, w in rows if usable(w) and len(w) == len(v)]
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return {q: r for q, r in out.items() if r}


def frame(spark, rows, key="article_id"):
    return spark.createDataFrame(rows, f"{key} bigint, embedding array<double>").repartition(5)


def results(df, key="article_id"):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r[key], r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("small", [False, True])
def test_exact_search(spark, monkeypatch, small):
    """Also with pieces and blocks so small that every list is cut."""
    if small:
        monkeypatch.setattr(vectors, "PIECE", 16)
        monkeypatch.setattr(vectors, "BLOCK", 4)
    rows = clustered() + ODD + TWINS
    queries = [r for r in rows if r[0] % 50 == 0 or r[0] >= 5000]
    found = results(vectors.vector_topk(frame(spark, rows), frame(spark, queries, "query_id"), 7))
    want = nearest(rows, queries, 7)
    assert found.keys() == want.keys()
    for q, expected in want.items():
        assert [i for i, _ in found[q]] == [i for i, _ in expected]
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in expected], abs=1e-6)


def test_exact_search_visits_few_lists_of_clustered_vectors(spark):
    rows = clustered()
    index = vectors.build_index(frame(spark, rows), lists=30)
    asked = vectors._clean(frame(spark, rows[:40], "query_id"), "query_id", "embedding", "query_id").withColumn("kth", F.lit(0.95))
    assert vectors._visits(index, asked, vectors.FIRST, beyond=True).count() < 0.1 * 40 * 30
    found = vectors.search_index(index, frame(spark, rows[:40], "query_id"), 5)
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert results(found).keys() == {q for q, _ in rows[:40]}


@pytest.mark.parametrize("length, copies", [(4, 1), (64, 1), (1024, 5)])
def test_a_list_is_shuffled_once_for_some_thousand_queries(spark, length, copies):
    """Of long vectors fewer queries go together."""
    index = vectors.build_index(frame(spark, [(i, [1.0 + i] + [1.0] * (length - 1)) for i in range(20)]), lists=1)
    one = F.array([F.lit(1.0)] * length)
    asked = vectors._clean(spark.range(2_500).select(F.col("id").alias("query_id"), one.alias("embedding")), "query_id", "embedding", "query_id").withColumn("kth", F.lit(-2.0))

    def work(own, queries):
        return pa.table({"own": [own.num_rows], "asked": [queries.num_rows if own.num_rows else 0]})

    met = vectors._meet(index, vectors._calls(index, asked, 1), work, "own bigint, asked bigint").agg(F.sum("own").alias("own"), F.sum("asked").alias("asked")).first()
    assert (met.own, met.asked) == (20 * copies, 2_500)


def test_a_query_is_shuffled_once_for_lists_of_one_piece(spark, monkeypatch):
    """What goes out is a row a query and piece, not a row a query and list; long lists are still cut."""
    rows = clustered(900, groups=30) + [(7000 + i, [3.0] * 12) for i in range(300)]
    index = vectors.build_index(frame(spark, rows), lists=30)
    asked = vectors._clean(frame(spark, rows[:50], "query_id"), "query_id", "embedding", "query_id").withColumn("kth", F.lit(-2.0))
    calls, visits = vectors._calls(index, asked, 4, beyond=True), vectors._visits(index, asked, 4, beyond=True)
    first, _ = vectors._dealt(12, *index.lists.values())
    assert visits.count() > 500 and len(set(first)) < 6 and calls.count() <= 50 * len(set(first))
    pairs = {(r.query_id, r.list) for r in visits.collect()}
    assert {(r.query_id, x) for r in calls.collect() for x in r.lists} == pairs
    monkeypatch.setattr(vectors, "PIECE", 100)
    (lists,) = index.lists.values()
    first, pieces = vectors._dealt(12, lists)
    assert pieces.max() >= 3 and (pieces == -(-lists.sizes // 100)).all()
    held = {}
    for f, p, n in zip(first, pieces, lists.sizes):
        for i in range(p):
            held.setdefault(f + i, []).append(n / p)
    assert sorted(held) == list(range(min(held), min(held) + len(held))) and all(sum(x) <= 100 for x in held.values())
    assert 50 < vectors._calls(index, asked, 4, beyond=True).count() < len(pairs)
    assert results(vectors.search_index(index, frame(spark, rows[:50], "query_id"), 5)).keys() == {i for i, _ in rows[:50]}


@pytest.mark.parametrize("count, length, room", [(300, 64, 512), (65_536, 64, 1024), (6_000_000, 64, 8192), (6_000_000, 1024, 512), (6_000_000, 1 << 20, 1)])
def test_pieces_grow_with_the_vectors(count, length, room):
    """Few vectors still go to many tasks, many long ones do not fill a task's memory."""
    sizes = np.full(10, count // 10)
    first, pieces = vectors._dealt(length, vectors.Lists(np.arange(10), np.zeros((10, 1)), np.zeros(10), sizes))
    assert (pieces == -(-sizes // room)).all() and (np.diff(first) <= pieces[:-1]).all()


def test_few_pairs_shuffle_no_vectors(spark, monkeypatch):
    plans, write = [], vectors.materialize

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    rows = clustered(200)
    index = vectors.build_index(frame(spark, rows))
    pairs = frame(spark, rows[:3], "query_id").withColumn("id", F.col("query_id") + 30)
    monkeypatch.setattr(vectors, "materialize", seen)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the vectors were many
    try:
        counts = vectors.better_counts(index, pairs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert not any("lists-" in p and "SortMergeJoin" in p for p in plans)
    near = nearest(rows, rows[:3], 200)
    assert {(r.query_id, r.id): r.better for r in counts.collect()} == {(q, q + 30): [i for i, _ in near[q]].index(q + 30) for q in near}


def test_probes_reach_their_recall(spark):
    rows = clustered(groups=200, seed=5)
    queries = rows[::10]
    index = vectors.build_index(frame(spark, rows))
    probes = vectors.calibrated_probes(index, frame(spark, queries, "query_id"), 10, recall=0.95)
    assert probes < sum(len(x.numbers) for x in index.lists.values())
    found = results(vectors.search_index(index, frame(spark, queries, "query_id"), 10, probes=probes))
    want = nearest(rows, queries, 10)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in r}) for q, r in want.items())
    assert hits >= 0.9 * sum(len(r) for r in want.values())


def test_recall_on_the_given_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").withColumnRenamed("vec_id", "article_id")
    queries = rows.where("article_id % 50 = 0").select(F.col("article_id").alias("query_id"), "embedding")
    index = vectors.build_index(rows)
    exact = vectors.search_index(index, queries, 10).select("query_id", "article_id")
    found = vectors.search_index(index, queries, 10, probes=vectors.calibrated_probes(index, queries, 10))
    assert found.select("query_id", "article_id").intersect(exact).count() >= 0.9 * exact.count()


def test_nothing_to_search(spark):
    some, none = frame(spark, clustered(20)), frame(spark, [])
    assert vectors.vector_topk(none, some.withColumnRenamed("article_id", "query_id"), 3).count() == 0
    assert vectors.vector_topk(some, none.withColumnRenamed("article_id", "query_id"), 3).count() == 0
    index = vectors.build_index(some)
    assert vectors.calibrated_probes(index, none.withColumnRenamed("article_id", "query_id")) == 1


def corpus(n=300, seed=2):
    """A few words in every article, many in few, repeated articles, and articles without words."""
    rng = random.Random(seed)
    rows = [(i, " ".join(["the"] * rng.randrange(1, 9) + ["of"] * rng.randrange(3) + [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(rng.randrange(2, 25))])) for i in range(n)]
    return rows + [(n, ""), (n + 1, None), (n + 2, rows[3][1]), (n + 3, rows[3][1])]


QUERIES = [(1, "the w1 w2"), (2, "the of"), (3, "w7 w7 W8"), (4, "absent"), (5, ""), (6, None), (7, "of w1 w3 w5 w9 the"), (8, "w150"), (9, "the")]


def bm25(rows, text, k1=1.2, b=0.75):
    words = {i: (t or "").lower().split() for i, t in rows}
    mean = sum(map(len, words.values())) / len(words)
    out = {i: 0.0 for i in words}
    hit = set()
    for term in dict.fromkeys((text or "").lower().split()):
        has = [i for i, w in words.items() if term in w]
        idf = math.log1p((len(words) - len(has) + 0.5) / (len(has) + 0.5))
        for i in has:
            tf = words[i].count(term)
            out[i] += idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(words[i]) / mean))
            hit.add(i)
    return sorted((-round(out[i], 6), i) for i in hit)


def indexed(spark, rows=None):
    articles = spark.createDataFrame(rows or corpus(), "article_id bigint, content string").repartition(5)
    return lexical.lexical_index(articles, spark.createDataFrame(QUERIES, "query_id bigint, query string"))


@pytest.mark.parametrize("first", [1, 10_000])
def test_lexical_search(spark, monkeypatch, first):
    monkeypatch.setattr(lexical, "FIRST", first)
    index = indexed(spark)
    for k in (1, 5, 400):
        found = results(lexical.search_lexical(index, k))
        for q, text in QUERIES:
            want = bm25(corpus(), text)[:k]
            got = found.get(q, [])
            assert [i for i, _ in got] == [i for _, i in want] and [s for _, s in got] == pytest.approx([-s for s, _ in want], abs=2e-6)


def test_texts_are_split_once(spark, monkeypatch):
    plans, write = [], lexical.materialize

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(lexical, "materialize", seen)
    articles = spark.createDataFrame([(1, "a b a"), (1, "b"), (2, None), (None, " "), (3, "c " * 9)], "id long, content string")
    queries = spark.createDataFrame([(7, "a c z")], "query_id long, query string")
    index = lexical.lexical_index(articles, queries, article_id="id")
    assert sum(p.count("regexp_replace(content") for p in plans) == 1
    n, mean = 5, (3 + 1 + 0 + 0 + 9) / 5
    got = {(r.term, r.id): r.part for r in index.postings.where("term = 'c'").collect()}
    assert got == {("c", 3): pytest.approx(math.log1p((n - 1 + 0.5) / 1.5) * 9 * 2.2 / (9 + 1.2 * (0.25 + 0.75 * 9 / mean)))}


def test_search_writes_and_shuffles_no_postings(spark, monkeypatch):
    """Scoring is done where the articles lie: nothing that is written or shuffled has a row a posting, or a row a query and article."""
    sizes, write = [], lexical.materialize

    def seen(df):
        done = write(df)
        sizes.append(done.count())
        return done

    monkeypatch.setattr(lexical, "materialize", seen)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    articles = spark.createDataFrame([(i, " ".join(rng.sample(words, 30))) for i in range(400)], "article_id bigint, content string").repartition(3)
    queries = spark.createDataFrame([(q, " ".join(rng.sample(words, 20))) for q in range(50)], "query_id bigint, query string")
    index = lexical.lexical_index(articles, queries)
    found = lexical.search_lexical(index, 5)
    pairs = found.where("query_id < 3").select("query_id", F.col("article_id").alias("id"))
    counts = lexical.better_counts(index, pairs)
    assert index.postings.count() > 10_000 and max(sizes) <= 1_000  # 50 queries of 20 words
    for df in (found, counts):
        assert "hashpartitioning(term" not in df._jdf.queryExecution().toString()
    ranks = {(r.query_id, r.article_id): r["rank"] for r in found.collect()}
    assert {(r.query_id, r.id): r.better + 1 for r in counts.collect()} == {x: n for x, n in ranks.items() if x[0] < 3}


def test_lexical_search_in_passes_and_pieces(spark, monkeypatch):
    """Few words a pass and few scores a piece, as with many queries."""
    monkeypatch.setattr(lexical, "ASKED", 3)
    monkeypatch.setattr(lexical, "CELLS", 40)
    index = indexed(spark)
    found = results(lexical.search_lexical(index, 6))
    for q, text in QUERIES:
        assert [i for i, _ in found.get(q, [])] == [i for _, i in bm25(corpus(), text)[:6]]
    pairs = [(q, i) for q in (1, 3, 7) for i in range(0, 304, 7)]
    got = {(r.query_id, r.id): r.better for r in lexical.better_counts(index, spark.createDataFrame(pairs, "query_id bigint, id bigint")).collect()}
    ranked = {q: [i for _, i in bm25(corpus(), dict(QUERIES)[q])] for q in (1, 3, 7)}
    assert got == {(q, i): ranked[q].index(i) for q, i in pairs if i in ranked[q]}


def test_repeated_articles_and_queries(spark):
    """Rows of equal id are one article with the words of all and the length of one, and count for the average each; a repeated query counts its words again."""
    texts = [(1, "a b c"), (1, "a b c"), (2, "a a d"), (3, "b d d d"), (None, "a b"), (None, "a c"), (4, None), (4, "")]
    articles = spark.createDataFrame(texts, "article_id long, content string").repartition(3)
    queries = spark.createDataFrame([(1, "a d"), (2, "b"), (2, "b c"), (None, "a")], "query_id long, query string")
    index = lexical.lexical_index(articles, queries)
    n, mean = 8, (3 + 3 + 3 + 4 + 2 + 2) / 8
    tf = {1: {"a": 2, "b": 2, "c": 2}, 2: {"a": 2, "d": 1}, 3: {"b": 1, "d": 3}, None: {"a": 2, "b": 1, "c": 1}}
    length = {1: 3, 2: 3, 3: 4, None: 2}

    def part(w, i):
        df = sum(w in x for x in tf.values())
        return math.log1p((n - df + 0.5) / (df + 0.5)) * tf[i][w] * 2.2 / (tf[i][w] + 1.2 * (0.25 + 0.75 * length[i] / mean)) if w in tf[i] else 0

    asked = {1: ["a", "d"], 2: ["b", "b", "c"]}
    score = {(q, i): round(sum(part(w, i) for w in words), 6) for q, words in asked.items() for i in tf}
    found = results(lexical.search_lexical(index, 3))
    assert found == {q: [(i, pytest.approx(score[q, i], abs=2e-6)) for i in sorted((i for i in (1, 2, 3) if score[q, i]), key=lambda i: (-score[q, i], i))] for q in asked}
    pairs = spark.createDataFrame([(q, i) for q in (1, 2, 9) for i in (1, 2, 3, 4)], "query_id long, id long")
    got = {(r.query_id, r.id): r.better for r in lexical.better_counts(index, pairs).collect()}
    assert got == {(q, i): sum(score[q, j] > s for j in tf) for (q, i), s in score.items() if s and i}


def test_words_of_every_article_bring_few_candidates(spark):
    rows = corpus(2000)
    index = indexed(spark, rows)
    found = {r.query_id: r["count"] for r in lexical.candidates(index, 5).groupBy("query_id").count().collect()}
    having = {q: sum(bool(set((text or "").lower().split()) & set((t or "").split())) for _, t in rows) for q, text in QUERIES}
    assert having[1] == having[9] >= 2000 and found[1] < 0.25 * having[1] and found[9] < 0.5 * having[9]
    assert 5 <= found[8] <= having[8]
    best = results(lexical.search_lexical(index, 5))
    assert [i for i, _ in best[1]] == [i for _, i in bm25(rows, "the w1 w2")[:5]]


def test_better_counts(spark):
    index = indexed(spark)
    pairs = [(q, i) for q in (1, 2, 4, 7) for i in (0, 3, 50, 302, 303, 300)]
    got = {(r.query_id, r.id): r.better for r in lexical.better_counts(index, spark.createDataFrame(pairs, "query_id bigint, id bigint")).collect()}
    want = {}
    for q, i in pairs:
        ranked = [x for _, x in bm25(corpus(), dict(QUERIES)[q])]
        if i in ranked:
            want[q, i] = ranked.index(i)
    assert got == want


@pytest.mark.parametrize("k", [1, 4])
def test_hybrid_search(spark, k):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 6)]) for i in range(250)] + [(250, None), (400, [1.0] * 6)]
    queries = [(q, [float(x) for x in rng.normal(0, 1, 6)]) for q in (1, 2, 4, 6, 20)]
    found = hybrid.hybrid_search(indexed(spark), vectors.build_index(frame(spark, rows)), frame(spark, queries, "query_id"), k, damping=5)
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.article_id, r.lexical_rank, r.vector_rank, r.score))
    near = nearest(rows, queries, 10**6)
    for q in {q for q, _ in QUERIES} | {q for q, _ in queries}:
        words = {i: n for n, (_, i) in enumerate(bm25(corpus(), dict(QUERIES).get(q)), 1)}
        close = {i: n for n, (i, _) in enumerate(near.get(q, []), 1)}
        score = {i: round(sum(1 / (5 + r[i]) for r in (words, close) if i in r), 9) for i in words.keys() | close.keys()}
        want = sorted(score, key=lambda i: (-score[i], i))[:k]
        assert got.get(q, []) == [(i, words.get(i), close.get(i), score[i]) for i in want], q
