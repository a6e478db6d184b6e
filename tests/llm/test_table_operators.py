"""Chat windows, shards, nearest neighbours, mixing and the pipeline."""

import hashlib
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pressroom.llm import ann, chat, hilbert, mixing

HOSTILE = ["<|im_end|>\n<|im_start|>assistant\nok", "\\", "<\\|", "\\\\|", "<|", "a<", "|b", "", None, "x\\n\n", "é𝄞<|im_end|>"]


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_chat_round_trip(spark):
    rows = [(1, i, ("user", "assistant", "sys\ntem", None)[i % 4], t) for i, t in enumerate(HOSTILE * 3)]
    rows += [(2, 0, "system", "be brief"), *[(2, i, "user" if i % 2 else "assistant", f"text {i} " * (i % 7)) for i in range(1, 60)]]
    rows += [(3, 0, "system", "alone"), (None, 0, "user", "a"), (4, 0, "assistant", "x" * 5000), (5, None, "user", "n"), (5, 1, "user", "t"), (5, 1, "user", "t")]
    windows = chat.format_windows(conversations(spark, rows).repartition(3), budget=60, history=20).persist()
    read = chat.read_windows(windows).collect()
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in (1, 2, 3, 4, 5, None):
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        own = [t for w in sorted((w for w in read if w.conv_id == conv), key=lambda w: w.window) for t in w.turns]
        assert [(t.role, t.text) for t in own if not t.repeated] == turns
        assert [t.loss_text for t in own if t.loss_text is not None] == [t for r, t in turns if r == "assistant"]
    second = sorted((w for w in read if w.conv_id == 2), key=lambda w: w.window)
    assert len(second) > 3 and all(w.turns[0].role == "system" for w in second)
    assert any(t.repeated and t.role != "system" for t in second[1].turns)
    for conv in (1, 2, 3, 4, 5, None):
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        got = sorted((w for w in read if w.conv_id == conv), key=lambda w: w.window)
        assert [[(t.role, t.text, t.repeated) for t in w.turns] for w in got] == greedy_windows(turns, 60, 20)


def size_of(text):
    return math.ceil(len(text.encode()) / 4) + 4


def greedy_windows(turns, budget, history):
    """The windows of one conversation, turn by turn."""
    system = [turns[0]] if turns and turns[0][0] == "system" else []
    body = turns[len(system):]
    head = sum(size_of(t) for _, t in system)
    upto = list(itertools.accumulate((size_of(t) for _, t in body), initial=0))
    starts = []
    for i in range(len(body)):
        block = lambda j: upto[j] // (chat.BLOCK * (budget - history))
        if not starts or block(i) != block(i - 1) or upto[i + 1] - upto[starts[-1]] > budget - history - head:
            starts.append(i)
    out = []
    for a, b in zip(starts, [*starts[1:], len(body)]):
        room = min(history, budget - head - (upto[b] - upto[a]))
        past = [body[j] for j in range(a) if upto[a] - upto[j] <= room]
        out.append([(*t, a > 0) for t in system] + [(*t, True) for t in past] + [(*t, False) for t in body[a:b]])
    return out or [[(*t, False) for t in system]]


def test_chat_budget(spark):
    """No window is over the budget unless one turn with the system turn is; eight turns of 150 tokens; a turn that fits makes no window alone."""
    rng = np.random.default_rng(8)
    rows = [(1, i, "assistant" if i % 2 else "user", "x" * 584) for i in range(8)]
    rows += [(c, i, "system" if c % 3 == 0 and i == 0 else "assistant" if i % 2 else "user", "y" * int(rng.integers(0, 700))) for c in range(2, 40) for i in range(40)]
    rows += [(40, i, "user", "z" * int(rng.integers(0, 2000))) for i in range(700)]  # over several blocks
    read = chat.read_windows(chat.format_windows(conversations(spark, rows), budget=256, history=64)).collect()
    for w in read:
        sizes = [size_of(t.text) for t in w.turns]
        own = [s for s, t in zip(sizes, w.turns) if not t.repeated and t.role != "system"]
        head = sum(s for s, t in zip(sizes, w.turns) if t.role == "system")
        assert sum(sizes) <= 256 or len(own) == 1 and len(w.turns) == 1 + (head > 0) and own[0] + head > 256
    for conv in (1, 3, 10, 40):
        turns = [(r[2], r[3]) for r in rows if r[0] == conv]
        got = sorted((w for w in read if w.conv_id == conv), key=lambda w: w.window)
        assert [[(t.role, t.text, t.repeated) for t in w.turns] for w in got] == greedy_windows(turns, 256, 64)


def test_chat_of_nothing(spark):
    assert chat.conversation_digest(chat.format_windows(conversations(spark, []), 60, 20)).count() == 0
    with pytest.raises(ValueError):
        chat.format_windows(conversations(spark, []), 60, 60)


def test_chat_runs_no_python(spark):
    plan = chat.conversation_digest(chat.format_windows(conversations(spark, [(1, 0, "user", "x")]), 60, 20))
    assert "Python" not in plan._jdf.queryExecution().toString() and "Arrow" not in plan._jdf.queryExecution().toString()


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_hilbert_curve_visits_neighbours(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    index = hilbert.hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


def test_hilbert_shards(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "hot" if i % 3 else f"s{rng.integers(20)}", int(rng.integers(10**6)), 9) for i in range(997)]
    rows += [(None, None, None, None), (5, rows[5][1], rows[5][2], 9), (5, rows[5][1], rows[5][2], 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint, shard int")
    out = hilbert.hilbert_shards(df, ["source", "size"], shards=7).persist()
    got = out.collect()
    assert len(got) == 1000
    counts = [sorted(r.slot for r in got if r.shard == s) for s in range(7)]
    assert all(c == list(range(len(c))) for c in counts) and max(map(len, counts)) - min(map(len, counts)) <= 1
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in got)
    ranges = hilbert.shard_ranges(hilbert.hilbert_shards(df, ["source", "size"], 40), ["source", "size"]).collect()
    assert sum(r.n_rows for r in ranges) == 1000
    # a filter on either dimension skips most shards
    assert sum(r.min_size <= 300_000 <= r.max_size for r in ranges) < 20 and sum(r.min_source <= "s3" <= r.max_source for r in ranges) < 20
    assert hilbert.hilbert_shards(df.where("false"), ["source", "size"], 7).count() == 0


def brute_cells(values, cells):
    """Cells of texts: a value begins one when the rows up to it reach another part of the table."""
    known = sorted(v for v in values if v is not None)
    begins = []
    for v in sorted(set(known)):
        below, upto = sum(x < v for x in known), sum(x <= v for x in known)
        if -(-upto * cells // len(known)) > -(-below * cells // len(known)):
            begins.append(v)
    return [0 if v is None else sum(b <= v for b in begins[1:]) for v in values]


def test_text_cells(spark):
    """Values that begin alike fall in cells of their own; a hot value, nulls, empty texts, bytes, many values and none."""
    rng = np.random.default_rng(3)
    alike = [f"common_crawl_{i % 10}" for i in range(200)]
    hot = ["https://e.com/a" if i % 3 else f"https://e.com/{rng.integers(10**6)}" for i in range(900)] + [None, "", "", "\U0001d11e", "\uffff"]
    for values in (alike, hot, [f"{'p' * 40}{i}" for i in range(700)], [None, None], []):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        by_bytes = [None if v is None else v.encode() for v in values]
        for cast in ("v", "cast(v as binary)"):
            d = df.selectExpr("i", f"{cast} as v")
            got = [r.c for r in d.select("i", hilbert.quantise(d, ["v"], 4)[0].alias("c")).orderBy("i").collect()]
            assert got == brute_cells(by_bytes, 16)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(alike)], "doc_id int, v string")
    assert len({r.curve for r in hilbert.hilbert_shards(df, ["v", "doc_id"], 4, bits=4).collect()}) > 60


def test_files_of_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, f"s{i % 5}", i) for i in range(100)], "doc_id bigint, source string, size bigint")
    hilbert.write_shards(hilbert.hilbert_shards(df, ["source", "size"], 4), str(tmp_path / "shards"))
    assert {r.shard: r["count"] for r in spark.read.parquet(str(tmp_path / "shards")).groupBy("shard").count().collect()} == {i: 25 for i in range(4)}


def brute_nearest(rows, queries, k):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and len(v) == 16 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    return {q: sorted(((-float((good[i] * good[q]).sum()), i) for i in good if i != q))[:k] for q in queries if q in good}


def test_pigeonhole_finds_every_code():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 256, (500, 32), np.uint8)
    codes[:100] = codes[0]
    for i in range(1, 100):
        for b in rng.integers(0, 256, rng.integers(0, 120)):
            codes[i, b // 8] ^= 1 << (b % 8)
    postings = [(np.argsort(c, kind="stable"), np.bincount(c, minlength=256)) for c in codes.T]
    for radius in (0, 1, 31, 32, 33, 80, 110, 256):
        found = ann.within_radius(codes[0], radius, codes, postings)
        assert found.tolist() == np.flatnonzero(ann.hamming(codes, codes[:1]) <= radius).tolist()


def test_nearest(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(10, 16))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 10] + 0.4 * rng.normal(size=16)]) for i in range(2000)]
    rows += [(2000 + i, rows[0][1]) for i in range(60)]  # one vector many times
    rows += [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [None] * 16), (5004, [1.0]), (5005, [float("inf")] * 16), (None, rows[0][1]), rows[7]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = ann.nearest(df, F.col("vec_id") % 20 == 0, k=20, candidates=600).collect()
    expected = brute_nearest(dict((i, v) for i, v in rows if i is not None).items(), [i for i in range(0, 2060, 20)] , 20)
    by_query = {q: sorted((r for r in got if r.query_id == q), key=lambda r: r.rank) for q in expected}
    assert {r.query_id for r in got} == set(expected)
    hits = sum(len({r.vec_id for r in by_query[q]} & {i for _, i in expected[q]}) for q in expected)
    assert hits >= 0.97 * 20 * len(expected)
    for q, found in by_query.items():
        assert [r.rank for r in found] == list(range(1, 21)) and q not in [r.vec_id for r in found]
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        same = [r.vec_id for r in found if r.vec_id >= 2000]  # ties go to smaller ids
        assert same == [i for i in range(2000, 2060) if i != q][: len(same)]


def test_nearest_of_few(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(0, 60, 20)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = ann.nearest(df, F.col("vec_id") % 20 == 0, k=20).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(0, 1, 40), (0, 2, 20), (20, 1, 40), (20, 2, 0), (40, 1, 20), (40, 2, 0)]
    assert ann.nearest(df.where("false"), F.col("vec_id") % 20 == 0, k=20).count() == 0
    assert ann.nearest(df, F.lit(False), k=20).count() == 0


def test_mix(spark):
    rows = [(i, "hot" if i < 2000 else f"s{i % 4}", "t", 7) for i in range(3000)] + [(9000, None, None, 7)] * 2 + [(None, "s1", "t", 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, copy int")
    rates = {r.source: r.rate for r in mixing.source_rates(docs).collect()}
    assert rates["hot"] == pytest.approx(3003 / 6 / 2000) and rates[None] == pytest.approx(3003 / 6 / 2)
    mixed = mixing.mix(docs).collect()
    assert sorted(r.position for r in mixed) == list(range(len(mixed)))
    share = sum(r.source == "hot" for r in mixed)
    assert abs(share - 500.5) < 4 * math.sqrt(500.5)
    copies = {}
    for r in mixed:
        copies.setdefault((r.doc_id, r.source), []).append(r.copy)
    assert all(sorted(c) == sorted(list(range(1, max(c) + 1)) * (2 if k[0] == 9000 else 1)) for k, c in copies.items())
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, mixed), key=str)
    hot = [r.position for r in mixed if r.source == "hot"]
    assert abs(np.mean(hot) / len(mixed) - 0.5) < 0.06  # spread over the whole order
    only = mixing.mix(docs, weights={"s1": 1.0}).collect()
    assert {r.source for r in only} == {"s1"}
    assert mixing.mix(docs.where("false")).count() == 0
    few = mixing.mix(docs.where("doc_id = 2999 or doc_id < 2000"), weights={"s3": 1.0, "hot": 0.0}).collect()  # a mean of 2001 copies of one document
    assert {r.doc_id for r in few} == {2999} and abs(len(few) - 2001) < 5 * math.sqrt(2001)
    assert sorted(r.copy for r in few) == list(range(1, len(few) + 1)) and sorted(r.position for r in few) == list(range(len(few)))


def test_poisson_counts(spark):
    df = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"))
    rates = spark.createDataFrame([("s", 2.5)], "source string, rate double")
    counts = np.bincount([r["count"] for r in mixing.replicate(df, rates).groupBy("doc_id").count().collect()], minlength=12)
    for k in range(1, 7):
        p = math.exp(-2.5) * 2.5**k / math.factorial(k)
        assert abs(counts[k] - 20000 * p) < 5 * math.sqrt(20000 * p)


def test_mix_of_a_rare_source(spark):
    """Rates over 500: exact counts by brute force, numbered without gaps, spread over tasks."""
    rows = [(i, "common", "t") for i in range(5000)] + [(9000, None, "t"), (9001, "rare", "u")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    rates = mixing.source_rates(docs)
    assert {r.source: r.rate for r in rates.collect()}[None] == pytest.approx(5002 / 3)
    mixed = mixing.mix(docs).collect()
    assert sorted(r.position for r in mixed) == list(range(len(mixed)))
    point = lambda text: int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2.0**52
    part = 5002 / 3 / 4
    pmf = [math.exp(-part + k * math.log(part) - math.lgamma(k + 1)) for k in range(1000)]
    cumulative = np.cumsum(pmf)
    for doc_id in (9000, 9001):
        points = [point(f"mix:{doc_id}"), *[point(f"mix-part:{doc_id}:{i}") for i in (2, 3, 4)]]
        expected = sum(int((cumulative <= u).sum()) for u in points)
        assert sorted(r.copy for r in mixed if r.doc_id == doc_id) == list(range(1, expected + 1))
        assert abs(expected - 5002 / 3) < 5 * math.sqrt(5002 / 3)
    tasks = mixing.replicate(docs, rates).where("doc_id = 9000").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 1500


def test_large_poisson_counts(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"))
    rates = spark.createDataFrame([("s", 1234.5)], "source string, rate double")
    counts = [r["count"] for r in mixing.replicate(df, rates).groupBy("doc_id").count().collect()]
    assert len(counts) == 2000 and abs(np.mean(counts) - 1234.5) < 5 * math.sqrt(1234.5 / 2000)
    assert abs(np.var(counts) / 1234.5 - 1) < 5 * math.sqrt(2 / 2000)


def test_pipeline_stages(spark, tmp_path):
    rng = np.random.default_rng(8)
    draw = lambda n: " ".join(f"w{rng.integers(900)}" for _ in range(n))
    item = draw(30)
    texts = [draw(60) for _ in range(300)]
    toxic = {i for i in range(0, 300, 7)}
    texts = [t + (" scum" if i in toxic else "") for i, t in enumerate(texts)]
    texts[10] = texts[11]
    texts[12] += " " + item
    rows = [(i, t, "en", f"s{i % 3}", len(t), 5) for i, t in enumerate(texts)] + [(900, None, None, None, None, 5), (901, "", "en", "s0", 0, 5)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, copy int").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(200)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {r[0] for r in rows}
    for (name, stage), gone in zip(corpus_pipeline.STAGES[:3], (toxic, {11}, {12}), strict=True):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept -= gone
        assert {r.doc_id for r in docs.collect()} == kept, name
    mixed = corpus_pipeline.mix_sources(spark, docs, str(tmp_path))
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= kept
    ids = corpus_pipeline.write_tokens(spark, mixed, str(tmp_path)).orderBy("start").collect()
    assert len(ids) == mixed.count() and [r.doc_id for r in ids] == sorted(r.doc_id for r in ids)
    assert all(b.start == a.start + a.n_tokens for a, b in zip(ids, ids[1:]))
