"""Token files, lengths, near duplicates, decontamination, toxicity and language-model scores against brute force."""

import gc
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pressroom.llm import decontaminate, lengths, neardup, ppm, token_file, tokens, toxicity
from pressroom.llm.words import shingles, split_words

PATH = tokens.tokenizer_path(tokens.DEFAULT_TOKENIZER)
ODD = ["", None, " \t", "a", "It's ... end. ...,x, é.", "x<|endoftext|>y <|ENDOFTEXT|>", "À́ 123.4 a.b.c.,.", "　tab\tx", ".,.,.,.,.", "İstanbul. ΑΣ."]
DOCS = "doc_id bigint, text string, extra int, score int, kept string"


def words(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())


def docs_of(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t, 1, 2, "k") for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(), st.text("aB. ,'\n")), max_size=8))
def test_encoder_equals_library(texts):
    from tokenizers import Tokenizer

    ids, at = tokens.WordEncoder(PATH).encode(pa.array([*texts, *ODD], pa.string()))
    library = Tokenizer.from_file(PATH).encode_batch([t or "" for t in [*texts, *ODD]], add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [e.ids for e in library]


def test_encoder_remembers_words_in_little_memory(monkeypatch):
    texts = [" ".join(f"w{i * 7919 % 100_003}x" for i in range(a, a + 1000)) for a in range(0, 40_000, 1000)]
    monkeypatch.setattr(tokens, "REMEMBERED", 700)
    forgetful = [tokens.WordEncoder(PATH).encode(pa.array([t]))[0].tolist() for t in texts[:3]]
    monkeypatch.undo()
    encoder = tokens.WordEncoder(PATH)
    encoder.encode(pa.array(["a"]))
    tracemalloc.start()
    try:
        got = [encoder.encode(pa.array([t]))[0].tolist() if i < 3 else len(encoder.encode(pa.array([t]))[0]) for i, t in enumerate(texts)]
        gc.collect()
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert got[:3] == forgetful and held < 80 * 40_000


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 2**32 - 1), st.integers(0, 40000), st.just(0)), max_size=300), min_size=1, max_size=5))
def test_pack_round_trip(documents):
    ids = np.array([i for d in documents for i in d], np.uint32)
    at = np.concatenate([[0], np.cumsum([len(d) for d in documents])])
    coded, words_at, escapes = token_file.pack(ids, at)
    assert (token_file.unpack(coded, escapes) == ids).all()
    counts = token_file.COUNTS[(coded >> np.uint64(60)).astype(int)]
    assert [int(counts[a:b].sum()) for a, b in zip(words_at[:-1], words_at[1:])] == [len(d) for d in documents]


def test_token_file(spark, tmp_path, tokenizer):
    texts = [*ODD, "word " * 70_000, "same", "same"]
    docs = docs_of(spark, texts).unionByName(docs_of(spark, ["same"], len(texts) - 1)).unionByName(docs_of(spark, ["null id"]).withColumn("doc_id", F.lit(None).cast("bigint")))
    token_file.write_ids(docs.repartition(5), str(tmp_path / "ids"), PATH, end_id=1)
    got = token_file.read_ids(spark, str(tmp_path / "ids")).orderBy("start").collect()
    expected, start = [], 0
    for doc_id, text in [(None, "null id"), *enumerate(texts), (len(texts) - 1, "same")]:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == expected


def test_token_file_of_nothing(spark, tmp_path):
    token_file.write_ids(docs_of(spark, []), str(tmp_path / "ids"), PATH)
    assert token_file.read_ids(spark, str(tmp_path / "ids")).count() == 0


def test_length_histogram(spark, tokenizer):
    texts = [*ODD, "a b c " * 5000, "a", "a"]
    found = sorted(len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False))
    histogram = lengths.length_histogram(docs_of(spark, texts), PATH).persist()
    for r in histogram.collect():
        limit = r.context_limit
        assert r.n_docs == found.count(limit) and r.tokens == limit * r.n_docs
        assert r.docs_at_least == sum(n >= limit for n in found) and r.docs_at_most == sum(n <= limit for n in found)
        assert r.tokens_at_least == sum(n for n in found if n >= limit) and r.truncated_total == sum(min(n, limit) for n in found)
        assert (r.total_docs, r.total_tokens) == (len(found), sum(found))
    assert histogram.count() == len(set(found))
    assert lengths.length_quantile(histogram, 0.5).first()[0] == found[math.ceil(len(found) / 2) - 1]
    assert lengths.truncated_total(histogram, 7).first()[0] == sum(min(n, 7) for n in found)
    assert lengths.length_histogram(docs_of(spark, []), PATH).count() == 0


def test_shingles_at_every_batch_size():
    texts = ["a b c d e", "A  b\nc", "", None, "x y z w", "q"]
    whole = shingles(split_words(pa.array(texts)), 4)
    for i, t in enumerate(texts):
        alone = shingles(split_words(pa.array([t], pa.string())), 4)[0]
        assert (alone == whole[0][whole[1][i] : whole[1][i + 1]]).all()
        assert len(alone) == (max(1, len(words(t)) - 3) if words(t) else 0)


def brute_components(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def mutated(rng, base, share):
    return " ".join(f"m{rng.integers(10**6)}" if rng.random() < share else w for w in base)


@pytest.mark.parametrize("n", [4, 5])
def test_near_duplicates(spark, n):
    rng = np.random.default_rng(n)
    texts = [*ODD, "A b C", "a B\nc", "a b d"]
    for size in (30, 120, 400):
        base = [f"w{rng.integers(500)}" for _ in range(size)]
        texts += [mutated(rng, base, share) for share in (0, 0, 0.005, 0.01, 0.02, 0.03, 0.04, 0.05, 0.08, 0.3) for _ in range(4)]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs_of(spark, texts).repartition(3), n, 80).collect()}
    assert got == brute_components(rows, n, 80)


def test_near_duplicate_rows_that_repeat(spark):
    docs = docs_of(spark, ["one two three four five six", "one two three four five six", "other words here"])
    nameless = docs_of(spark, ["one two three four five six"]).withColumn("doc_id", F.lit(None).cast("bigint"))
    kept = neardup.without_near_duplicates(docs.unionByName(docs).unionByName(nameless))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 0), (False, 2), (True, None)]
    assert neardup.near_duplicates(docs_of(spark, [])).count() == 0
    with pytest.raises(ValueError):
        neardup.near_duplicates(docs, percent=50)


def brute_alignment(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if x == y else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 4), min_size=1, max_size=20), st.lists(st.integers(0, 4), min_size=1, max_size=9)), min_size=1, max_size=5))
def test_local_alignment(pairs):
    score, _ = decontaminate.local_alignment(*[[np.array(p[k], np.uint64) for p in pairs] for k in (0, 1)])
    assert score.tolist() == [brute_alignment(a, b) for a, b in pairs]


def test_contaminated_documents(spark):
    rng = np.random.default_rng(3)
    draw = lambda n: [f"w{rng.integers(3000)}" for _ in range(n)]
    items = [draw(30), draw(45), draw(15), ["the", "of", "and"] * 3, draw(2)]
    edited = list(items[1])
    edited[10] = "changed"
    del edited[20]
    edited.insert(33, "added")
    texts = [" ".join(draw(300)) for _ in range(20)]
    texts += [" ".join([*draw(200), *items[0], *draw(5000)]), " ".join([*draw(50), *edited, *draw(50)]).upper(), " ".join([*items[2], *draw(9)]), "the of and " + " ".join(draw(50))]
    texts += [" ".join(items[4]), "", None, " ".join(items[1][:15])]
    texts += [" ".join([*draw(20), *items[0], *draw(20)]) for _ in range(40)]  # as frequent as a stock phrase
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(90, None), (91, ""), (None, "x y z")], "item_id bigint, text string")
    docs = docs_of(spark, texts)
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs.unionByName(docs), benchmark).collect()}
    brute = set()
    for d, t in enumerate(texts):
        for i, x in enumerate(items):
            item, w = [v.encode() for v in x], words(t)
            if w and brute_alignment(w, item) >= 0.6 * 2 * len(item):
                brute.add((d, i))
    assert {(20, 0), (21, 1), (22, 2), (24, 4)} <= brute and got == brute
    clean = decontaminate.without_contaminated(docs, benchmark)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in brute}
    assert decontaminate.contaminated(docs_of(spark, []), benchmark).count() == 0
    assert decontaminate.contaminated(docs, benchmark.where("false")).count() == 0


def test_contamination_at_the_threshold(spark, monkeypatch):
    """Words put in after every second one, short items inside long documents, common pairs, repeated words, an id with two texts."""
    rng = np.random.default_rng(12)
    draw = lambda n, of=60: [f"w{rng.integers(of)}" for _ in range(n)]
    items = [draw(40, 5000), ["to", "be"], ["solo"], draw(5, 5000), draw(6, 5000), ["the", "of"] * 8, *[draw(int(n)) for n in rng.integers(1, 25, 30)]]

    def noisy(item, every, what):
        out = []
        for i, w in enumerate(item):
            out += [w] if what == "in" or (i + 1) % every else [] if what == "out" else ["x"]
            out += ["x"] if what == "in" and (i + 1) % every == 0 else []
        return out

    texts = [[*draw(30), *noisy(x, every, what), *draw(30)] for x in items for every in (1, 2, 3, 4) for what in ("in", "out", "other")]
    texts += [draw(int(n)) for n in rng.integers(1, 400, 60)] + [["a", "to", "be"] * 50, ["the"] * 300, ["of", "the"] * 100, [*draw(3000), "solo"]]
    benchmark = spark.createDataFrame([(i // 2 if i > 30 else i, " ".join(x)) for i, x in enumerate(items)], "item_id bigint, text string")
    docs = docs_of(spark, [" ".join(t) for t in texts])
    brute = {}
    for d, t in enumerate(texts):
        for i, x in enumerate(items):
            score = brute_alignment([v.encode() for v in t], [v.encode() for v in x])
            if score >= 0.6 * 2 * len(x) - 1e-9:
                key = d, i // 2 if i > 30 else i
                brute[key] = max(brute.get(key, 0), score / (2 * len(x)))
    assert (3, 0) in brute and (len(texts) - 1, 2) in brute
    for places in (1_000_000, 50):  # all items at once, and in blocks
        monkeypatch.setattr(decontaminate, "PLACES", places)
        got = {(r.doc_id, r.item_id): r.coverage for r in decontaminate.contaminated(docs, benchmark).collect()}
        assert got.keys() == brute.keys() and all(abs(got[k] - brute[k]) < 1e-9 for k in got)


def test_toxicity_on_held_out_rows(spark):
    rng = np.random.default_rng(0)
    plain = lambda n: [f"w{rng.integers(400)}" for _ in range(n)]
    texts, labels = [], []
    for i in range(900):
        toxic = i % 5 == 0
        bad = [f"vile{'abcdefghij'[rng.integers(10)]}x", "scum"][rng.integers(2)]
        w = plain(int(rng.integers(20, 300)))
        if toxic:
            w.insert(int(rng.integers(len(w))), bad)
        texts.append(" ".join(w))
        labels.append((i, int(toxic)))
    docs = docs_of(spark, [*texts, "", None])
    table = spark.createDataFrame([*labels, (3, None), (None, 1), (10**6, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, table, F.col("doc_id") % 3 != 0)
    got = {r.doc_id: r.score for r in toxicity.scored(docs, model, ["doc_id", "kept"]).collect()}
    held = [(got[i], t) for i, t in labels if i % 3 == 0]
    assert len(got) == 902 and sum((s >= 0.5) == t for s, t in held) >= 0.98 * len(held)
    assert got[900] == got[901] < 0.5 and all(0 <= s <= 1 for s in got.values())


def test_toxicity_learns_pairs():
    """Two terms that are harmless alone and toxic together: beyond any sum of weights."""
    rng = np.random.default_rng(1)
    both, rows, terms = [], [], []
    for i in range(2000):
        a, b = rng.random(2) < 0.5
        rows += [i] * (int(a) + int(b))
        terms += [1] * int(a) + [2] * int(b)
        both.append(float(a and b))
    rows, terms, y = np.array(rows), np.array(terms, np.uint64), np.array(both)
    model = toxicity.fit(rows, terms, y)
    score = model.score(rows, terms, 2000)
    assert ((score >= 0.5) == y).all() and np.abs(model.factors).max() > 0.05


@pytest.mark.parametrize("labels", [[], [(0, 0), (1, 0)]])
def test_toxicity_without_both_labels(spark, labels):
    docs = docs_of(spark, ["a b", "c"])
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), F.lit(True))
    assert [round(r.score, 3) for r in toxicity.scored(docs, model, ["doc_id"]).collect()] == [0.0, 0.0] or not labels


class Brute:
    def __init__(self, texts):
        self.words, self.contexts = Counter(), defaultdict(Counter)
        for t in texts:
            self.words.update([*words(t), None])
            z = self.symbols(t)
            for k in range(5, len(z)):
                for o in range(6):
                    self.contexts[tuple(z[k - o : k])][z[k]] += 1
        self.n, self.v = sum(self.words.values()), len(self.words)

    def symbols(self, t):
        return [257] * 5 + list(b" ".join(words(t))) + [256]

    def base(self, t):
        return sum(math.log10((self.words.get(w, 0) + 0.1) / (self.n + 0.1 * (self.v + 1))) for w in [*words(t), None])

    def score(self, t):
        z, total = self.symbols(t), 0.0
        for k in range(5, len(z)):
            excluded = set()
            for o in range(5, -1, -1):
                seen = self.contexts.get(tuple(z[k - o : k]), {})
                left = {s: c for s, c in seen.items() if s not in excluded}
                if not left:
                    continue
                mass = sum(left.values())
                if z[k] in left:
                    total += math.log10((left[z[k]] - 0.5) / mass)
                    break
                total += math.log10(len(left) / (2 * mass))
                excluded |= set(seen)
            else:
                total -= math.log10(257 - len(self.contexts.get((), {})))
        return total


@pytest.mark.parametrize("learn", ["doc_id % 4 != 0", "false", "true"])
def test_ppm(spark, monkeypatch, learn):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", 4000)  # several blocks
    rng = np.random.default_rng(5)
    texts = [" ".join("".join(rng.choice(list("abé"), rng.integers(1, 4))) for _ in range(rng.integers(1, 60))) for _ in range(60)]
    texts += [*ODD, "Same TEXT", "same text", "zzz \x01", "word " * 3000]
    docs = docs_of(spark, texts)
    got = {r.doc_id: r for r in ppm.score_documents(docs, F.expr(learn)).collect()}
    taught = {"doc_id % 4 != 0": lambda i: i % 4 != 0, "false": lambda i: False, "true": lambda i: True}[learn]
    brute = Brute([t for i, t in enumerate(texts) if taught(i)])
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i].score == pytest.approx(brute.score(t), rel=1e-5) and got[i].base_score == pytest.approx(brute.base(t) if brute.n else got[i].base_score, rel=1e-9)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(words(t)) + 1, sum(w in brute.words for w in [*words(t), None]), brute.n)


def test_ppm_of_nothing(spark):
    assert ppm.score_documents(docs_of(spark, []), F.lit(True)).count() == 0


@pytest.mark.parametrize("case", ["either but not both", "insult with a mention"])
def test_toxicity_trains_on_pairs(spark, case):
    """Whole training: words that say nothing alone, or of which one does, and what both together say, among many others."""
    rng = np.random.default_rng(2)
    texts, labels = [], []
    for i in range(4000):
        filler = [f"w{rng.integers(400)}" for _ in range(int(rng.integers(10, 60)))]
        a, b = (int(x) for x in rng.random(2) < (0.5, 0.5 if case.startswith("either") else 0.2))
        filler += ["alpha"] * a + ["omega"] * b
        rng.shuffle(filler)
        texts.append(" ".join(filler))
        labels.append((i, int(a != b) if case.startswith("either") else a & b))
    docs, table = docs_of(spark, texts), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.train(docs.repartition(3), table, F.col("doc_id") % 4 != 0)
    got = {r.doc_id: r.score >= 0.5 for r in toxicity.scored(docs, model, ["doc_id"]).collect()}
    held = [(got[i], bool(t)) for i, t in labels if i % 4 == 0]
    assert sum(a == b for a, b in held) >= 0.98 * len(held)
    again = toxicity.train(docs.repartition(7), table, F.col("doc_id") % 4 != 0)
    assert (again.terms == model.terms).all() and np.allclose(again.weights, model.weights)


def test_toxicity_of_long_documents(spark):
    """The task that fits gets the terms that matter, however many others a document has."""
    rng = np.random.default_rng(3)
    texts = [" ".join([f"x{i}y{k}" for k in range(4000)] + ["vile"] * (i % 2) + [f"w{rng.integers(9)}" for _ in range(9)]) for i in range(60)]
    docs, table = docs_of(spark, texts), spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, table, F.lit(True))
    assert 0 < len(model.terms) < 40
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in toxicity.scored(docs, model, ["doc_id"]).collect())
