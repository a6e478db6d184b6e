"""What comes after ingestion, on cases with one right answer."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressroom.operators import library, near, vectors
from pressroom.operators.components import connected_components


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)]
    edges = spark.createDataFrame([*chain, (500, 400), (500, 450), (7, 7), (500, 400)], "a bigint, b bigint")
    got = {r.id: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 400: 400, 450: 400, 500: 400}
    assert connected_components(edges.where("false")).count() == 0


def test_canonical_articles(spark):
    rows = [(1, "u1", "h1"), (2, "u2", "h1"), (3, "u2", "h3"), (4, None, None), (5, None, None), (6, "u6", "h6")]
    df = spark.createDataFrame(rows, "article_id bigint, url string, content_hash string")
    links = spark.createDataFrame([(6, 3)], "a bigint, b bigint")
    got = {r.article_id: r.canonical_id for r in library.canonical_articles(df, ["url", "content_hash"], links=links).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 1}


def test_near_duplicates_against_brute_force(spark):
    """Groups around one text, chains whose ends are unlike, copies, short, empty and null texts."""
    rng = np.random.default_rng(3)
    draw = lambda n: [f"w{rng.integers(500)}" for _ in range(n)]
    texts = [" ".join(draw(40)) for _ in range(60)]
    for _ in range(5):
        words = draw(80)
        for _ in range(20):
            texts.append(" ".join(words))
            words = list(words)
            words[int(rng.integers(80))] = f"x{rng.integers(10**6)}"
    hot = draw(60)
    for i in range(80):
        changed = list(hot)
        changed[i % 60] = f"y{i}"
        texts.append(" ".join(changed))
    texts += [texts[0], texts[0].upper(), "a b", "A  b\n", "a", "", None, " "]
    order = rng.permutation(len(texts))
    rows = [(int(i), texts[j]) for i, j in enumerate(order)]
    df = spark.createDataFrame(rows, "id bigint, text string").repartition(5)

    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = {(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows)) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) > 0}
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    links = near.near_links(df, "id", "text")
    assert {(r.a, r.b) for r in links.collect()} <= pairs
    got = {r.id: r.canonical_id for r in library.canonical_articles(df, [], "id", links).collect()}
    assert got == {i: find(i) for i in range(len(rows))}
    assert near.near_links(df.where("false"), "id", "text").count() == 0


def test_prefixes_are_long_enough():
    """Of any two sets similar enough, in any order of shingles, the prefixes for each other's class meet; checked at the least overlap."""
    for m in [*range(1, 60), 100, 333, 1000]:
        for n in range(-(-80 * m // 100), 100 * m // 80 + 1):
            overlap = -(-80 * (m + n) // 180)
            if overlap > min(m, n):
                continue
            mine, theirs = dict(near.prefixes(m, 80)), dict(near.prefixes(n, 80))
            assert mine[near.size_class(n)] >= m - overlap + 1 and theirs[near.size_class(m)] >= n - overlap + 1
            assert near.prefixes(m, 80)[0][1] <= m - -(-80 * m // 100) + 1


def test_near_duplicates_in_a_bucket_of_boilerplate(spark, monkeypatch):
    """A third of all texts share most of their words and are no near duplicates, but for some pairs and a chain among them."""
    monkeypatch.setattr(near, "BLOCK", 16)
    rng = np.random.default_rng(8)
    draw = lambda n: [f"w{rng.integers(10**6)}" for _ in range(n)]
    boiler = draw(110)
    texts = [boiler + draw(40) for _ in range(120)]
    texts += [t[:140] + draw(10) for t in texts[:15]]  # near copies of some of them
    chain = boiler + draw(40)
    for i in range(12):
        chain = chain[:100] + chain[110:] + draw(10) if i else chain
        texts.append(list(chain))
    texts += [draw(60) for _ in range(200)]
    sets = [{tuple(t[i : i + 4]) for i in range(len(t) - 3)} for t in texts]
    pairs = {(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert 20 < len(pairs) < 200
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "id bigint, text string").repartition(5)
    links = near.near_links(df, "id", "text")
    assert {(r.a, r.b) for r in links.collect()} <= pairs
    edges = spark.createDataFrame(sorted(pairs), "a bigint, b bigint")
    assert {tuple(r) for r in connected_components(links).collect()} == {tuple(r) for r in connected_components(edges).collect()}


def test_language(spark):
    texts = ["Der Hund und die Katze", "the end of it", "el perro que no", "le chat et les", "xyz", "", None, "die the"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(2)
    assert [r.x for r in df.select("i", library.language_id("t").alias("x")).orderBy("i").collect()] == ["de", "en", "es", "fr", None, None, None, "de"]


def test_language_against_the_yardstick(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 200")
    named = d.select(F.col("lang"), library.language_id("text").alias("x"))
    row = named.agg(F.avg(F.col("x").isNotNull().cast("double")).alias("named"), F.avg((F.col("x") == F.col("lang")).cast("double")).alias("right")).first()
    assert row.named > 0.9 and row.right > 0.98  # the rest is junk without any function word


def test_chunks_cover_every_word(spark):
    texts = {i: " ".join(f"w{k}" for k in range(n)) for i, n in enumerate([0, 1, 5, 6, 7, 11, 500])}
    df = spark.createDataFrame(list(texts.items()), "article_id int, content string")
    got = {}
    for r in library.chunk_articles(df, 6, 2).orderBy("article_id", "chunk_no").collect():
        got.setdefault(r.article_id, []).append(r.chunk.split())
    assert 0 not in got
    for i, chunks in got.items():
        assert all(a[-2:] == b[:2] for a, b in zip(chunks, chunks[1:])) and all(len(c) == 6 for c in chunks[:-1])
        assert [*chunks[0], *[w for c in chunks[1:] for w in c[2:]]] == texts[i].split()
    with pytest.raises(ValueError):
        library.chunk_articles(df, 5, 5)


def test_vectors_that_take_no_part(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0]), (5, [2.0, 2.0])], "article_id int, embedding array<float>")
    got = [(r.rank, r.article_id, r.score) for r in vectors.vector_topk(v, v.where("article_id = 1").withColumnRenamed("article_id", "query_id"), 3).collect()]
    assert sorted(got) == [(1, 1, 1.0), (2, 5, 0.707107)]


def test_hybrid_rank(spark):
    a = spark.createDataFrame([("q", 1, 10), ("q", 2, 11)], "query_id string, rank int, article_id int")
    b = spark.createDataFrame([("q", 1, 11), ("q", 2, 12)], "query_id string, rank int, article_id int")
    assert [r.article_id for r in library.hybrid_rank(a, b).orderBy("rank").collect()] == [11, 10, 12]
