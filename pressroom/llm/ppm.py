"""Language-model scores by prediction by partial matching over bytes.

A text is its words, lower-cased in ASCII, one space between, and an end sign. The model is a trie of the contexts of up to five symbols
of all training documents, as counts of six-symbol runs. A symbol is predicted by the longest context that was seen; a context
that lacks it gives the escape share distinct / (2 * total), taken as half a count from each of its symbols, and the next shorter context predicts among the symbols that
the longer one lacks (symbol exclusion). Below the empty context all symbols not yet excluded are alike.

Nothing of the model is on one machine. Documents are dealt to blocks; each block counts its distinct runs and words and sends
them, packed, to buckets. A bucket holds all runs with the same last two context symbols, so every context of two symbols or more with
all its shorter and longer kin; contexts of one symbol and none (at most 258 x 257 counts) are summed up and given to each task.
Buckets add up the training counts and answer every block with the log probability of each of its runs, and blocks sum these up per
document. Counts cover all training documents.

The base score is that of a unigram model of words with add-0.1 smoothing, counted in the same exchange.

A null or blank text is an end sign alone. Rows whose mark is null, as with a null doc_id, are scored but not learned from. Repeated rows are scored
alike and counted each. Without training documents all symbols are alike. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.llm.words import U64, mix, pieces, split_words
from pressroom.session import materialize

ORDER = 5
SPACE, END, START, SYMBOLS = 32, 256, 257, 257  # START stands before a text only
BITS = 9
#: Bytes of text in a block.
BLOCK_BYTES = 16 << 20
#: Bytes of text that a task works on at once, in arrays of about a hundred bytes a symbol.
PIECE_BYTES = 1 << 20
MAX_BUCKETS = 4096
_RUN, _WORD = 0, 1


def packed(values: np.ndarray) -> bytes:
    """Bytes of equal rank side by side, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes())


def unpacked(data: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def low(n: int) -> np.uint64:
    """Mask of the last ``n`` symbols of a run."""
    return U64((1 << BITS * n) - 1)


def runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The run (context and symbol) at every symbol of every text, where each text begins in them, and the words' hashes and bounds."""
    w = split_words(column)
    n_texts, n_words = len(w.bounds) - 1, len(w.hash)
    text = np.repeat(np.arange(n_texts), np.diff(w.bounds))
    sizes = w.end - w.start
    # every word is followed by one sign; a text without words is an end sign; ORDER start signs stand before each text
    empty = np.diff(w.bounds) == 0
    signs = np.bincount(text, sizes + 1, n_texts).astype(np.int64) + empty
    begin = np.concatenate([[0], np.cumsum(signs + ORDER)])
    ahead = np.concatenate([[0], np.cumsum(sizes + 1)])
    first_word = np.minimum(w.bounds[:-1], n_words)
    place = ahead[:-1] - ahead[first_word][text] + begin[:-1][text] + ORDER
    out = np.full(begin[-1], START, np.uint16)
    spell = np.repeat(place - w.start, sizes)
    inside = np.repeat(w.start - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum()) if n_words else np.zeros(0, np.int64)
    byte = w.data[inside].astype(np.uint16)
    capital = (byte >= 65) & (byte <= 90)
    out[inside + spell] = np.where(capital, byte + 32, byte)
    out[place + sizes] = SPACE
    out[begin[1:] - 1] = END
    codes = np.zeros(max(len(out) - ORDER, 0), U64)
    for k in range(ORDER + 1):
        codes = codes << U64(BITS) | out[k : k + len(codes)].astype(U64)
    at = begin[:-1] - ORDER * np.arange(n_texts)
    real = np.ones(len(codes), bool)
    for k in range(ORDER):  # runs that end in a start sign of the next text
        real[begin[1:-1] + k - ORDER] = False
    return codes[real], np.append(at, at[-1] + signs[-1] if n_texts else 0), w


def counted(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their summed weights."""
    found, inverse = np.unique(keys, return_inverse=True)
    return found, np.bincount(inverse, weights, len(found)).astype(np.uint32)


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Several lists of distinct keys and counts as one."""
    keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(keys))


class Lookup:
    """Values of 64-bit keys by open addressing, for many lookups of keys that are there."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(keys) - 1).bit_length() + 1) if len(keys) else 4
        self.shift, self.mask = U64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, ~U64(0)), np.zeros(1 << bits, values.dtype)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slot] == ~U64(0)
            self.keys[slot[free]] = keys[left[free]]  # of several for one slot the last stays
            here = self.keys[slot] == keys[left]
            self.values[slot[here]] = values[left[here]]
            slot, left = (slot[~here] + 1) & self.mask, left[~here]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        other = np.flatnonzero(self.keys[slot] != keys)
        while len(other):
            slot[other] = (slot[other] + 1) & self.mask
            other = other[self.keys[slot[other]] != keys[other]]
        return self.values[slot]


@dataclass
class Level:
    """Counts of one order: runs in order, their contexts, and what the symbols of the next longer contexts take away from them."""

    runs: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    totals: np.ndarray
    distinct: np.ndarray
    taken: np.ndarray  # for each context of the next longer order: counts here of the symbols seen there
    longer: Level | None = None


def levels(runs_of: dict[int, tuple[np.ndarray, np.ndarray]]) -> dict[int, Level]:
    """Levels by order, from distinct runs (of order + 1 symbols) and their counts."""
    out: dict[int, Level] = {}
    for order in sorted(runs_of, reverse=True):
        keys, counts = runs_of[order]
        contexts, first = np.unique(keys >> U64(BITS), return_index=True)
        ends = np.append(first, len(keys))
        totals = np.add.reduceat(counts.astype(np.float64), first) if len(keys) else np.zeros(0)
        longer = out.get(order + 1)
        taken = np.zeros(0)
        if longer is not None and len(longer.runs):
            at = np.searchsorted(keys, longer.runs & low(order + 1))
            owner = np.searchsorted(longer.contexts, longer.runs >> U64(BITS))
            taken = np.bincount(owner, counts[at].astype(np.float64), len(longer.contexts))
        out[order] = Level(keys, counts, contexts, totals, np.diff(ends).astype(np.float64), taken, longer)
    return out


def find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def log_probabilities(keys: np.ndarray, model: dict[int, Level]) -> np.ndarray:
    """log10 of the probability of each run's symbol after its context."""
    out = np.zeros(len(keys))
    left = np.arange(len(keys))
    above = np.full(len(keys), -1)  # number of the context one order longer, if it was seen
    for order in range(ORDER, -1, -1):
        level, k = model[order], keys[left]
        at, seen = find(level.contexts, (k & low(order + 1)) >> U64(BITS))
        less, fewer = np.zeros(len(k)), np.zeros(len(k))
        had = above >= 0
        if had.any():
            less[had], fewer[had] = level.taken[above[had]], level.longer.distinct[above[had]]
        total = np.where(seen, level.totals[at] - less if len(level.totals) else 0, 0)
        distinct = np.where(seen, level.distinct[at] - fewer if len(level.totals) else 0, 0)
        run, hit = find(level.runs, k & low(order + 1))
        out[left[hit]] += np.log10((level.counts[run[hit]] - 0.5) / total[hit])
        escape = ~hit & (distinct > 0)
        out[left[escape]] += np.log10(distinct[escape] / (2 * total[escape]))
        left, above = left[~hit], np.where(seen, at, -1)[~hit]
    known = len(model[0].runs)
    out[left] -= np.log10(max(SYMBOLS - known, 1))
    return out


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Runs with the same last two context symbols share a bucket."""
    return (mix((keys & low(3)) >> U64(BITS)) % U64(n)).astype(np.int32)


def score_documents(docs: DataFrame, learn: Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every document; ``learn`` marks training rows (null: not).

    ``score`` is the model's log10 probability of the text, ``base_score`` that of the unigram model.
    """
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
    )
    size, n_docs, n_learn = narrow.agg(F.sum(F.octet_length("text")), F.count("*"), F.sum(F.col("learn").cast("int"))).first()
    n_blocks = max(1, -(-((size or 0) + 16 * n_docs) // BLOCK_BYTES))
    n_buckets = min(MAX_BUCKETS, max(16, n_blocks // 4))
    # dealt by id and text, so the rows of one id don't gather
    blocks = narrow.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int"))

    asked = "bucket int, kind int, block int, keys binary, counts binary"
    names = [c.split()[0] for c in asked.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def count(table: pa.Table) -> pa.Table:
        parts: dict[int, list] = {_RUN: [], _WORD: []}
        for batch in table.to_batches():
            for piece in pieces(batch, "text", PIECE_BYTES):
                codes, at, w = runs(piece.column("text"))
                mine = piece.column("learn").to_numpy(zero_copy_only=False)
                parts[_RUN].append(counted(codes, np.repeat(mine, np.diff(at))))
                parts[_WORD].append(counted(w.hash, np.repeat(mine, np.diff(w.bounds))))
                if len(parts[_RUN]) >= 8:
                    parts = {kind: [summed(found)] for kind, found in parts.items()}
        rows = []
        block = table.column("block")[0].as_py()
        for kind, found in parts.items():
            keys, counts = summed(found)
            bucket = bucket_of(keys, n_buckets) if kind == _RUN else (keys % U64(n_buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            for b in range(n_buckets):
                own = order[cuts[b] : cuts[b + 1]]
                if len(own):
                    rows.append((b, kind, block, packed(keys[own]), packed(counts[own].astype("<u4"))))
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(5)], names)

    sent = materialize(blocks.groupBy("block").applyInArrow(count, asked))

    def short_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                k, n = unpacked(keys, "<u8"), unpacked(counts, "<u4")
                k, n = counted((k & low(2))[n > 0], n[n > 0])
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n.astype(np.int64))], ["run", "n"])

    of_runs = sent.where(F.col("kind") == _RUN).select("keys", "counts")
    pairs = of_runs.mapInArrow(short_runs, "run bigint, n bigint").groupBy("run").agg(F.sum("n").alias("n")).orderBy("run").toPandas()
    pair_keys, pair_counts = pairs["run"].to_numpy(np.int64).view(U64), pairs["n"].to_numpy(np.float64)  # at most 258 x 257
    single = np.unique(pair_keys & low(1), return_inverse=True)
    single_keys, single_counts = single[0], np.bincount(single[1], pair_counts, len(single[0]))

    # each bucket sees all counts first and then answers block by block, holding its own distinct keys only
    phases = sent.withColumn("phase", F.explode(F.array(F.lit(0), F.lit(1))))
    dealt = phases.repartition("bucket", "kind").sortWithinPartitions("bucket", "kind", "phase", "block")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, gathered, table = None, [], None

        def built(kind: int) -> tuple[np.ndarray, np.ndarray]:
            keys, counts = summed(gathered)
            if kind == _WORD:
                return keys, counts
            taught = counts > 0
            of = {ORDER: (keys[taught], counts[taught])}
            for order in range(ORDER - 1, 1, -1):
                k, inverse = np.unique(of[order + 1][0] & low(order + 1), return_inverse=True)
                of[order] = k, np.bincount(inverse, of[order + 1][1], len(k))
            of[1], of[0] = (pair_keys, pair_counts), (single_keys, single_counts)
            return keys, log_probabilities(keys, levels(of))

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if (row["bucket"], row["kind"]) != now:
                    now, gathered, table = (row["bucket"], row["kind"]), [], None
                keys = unpacked(row["keys"], "<u8")
                if row["phase"] == 0:
                    gathered.append((keys, unpacked(row["counts"], "<u4")))
                    if len(gathered) >= 16:
                        gathered[:] = [summed(gathered)]
                    continue
                if table is None:
                    table = built(row["kind"])
                    gathered = []
                values = table[1][np.searchsorted(table[0], keys)]
                out.append((row["kind"], row["block"], row["keys"], packed(values.astype("<f4" if row["kind"] == _RUN else "<f8"))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((*kinds[1:4], pa.binary()))], ["kind", "block", "keys", "answers"])

    answers = materialize(dealt.mapInArrow(answer, "kind int, block int, keys binary, answers binary"))

    def vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, gathered = None, []

        def total() -> pa.RecordBatch:
            _, counts = summed(gathered)
            return pa.RecordBatch.from_arrays([pa.array([int((counts > 0).sum())]), pa.array([int(counts.sum())])], ["words", "tokens"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != now and gathered:
                    yield total()
                    gathered = []
                now = row["bucket"]
                gathered.append((unpacked(row["keys"], "<u8"), unpacked(row["counts"], "<u4")))
                if len(gathered) >= 16:
                    gathered = [summed(gathered)]
        if gathered:
            yield total()

    words = sent.where(F.col("kind") == _WORD).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(vocabulary, "words bigint, tokens bigint")
    n_words, n_tokens = words.agg(F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    taught = int(n_learn or 0)
    v, n = n_words + (taught > 0), n_tokens + taught

    result = "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"

    def score(table: pa.Table, found: pa.Table) -> pa.Table:
        lookups, answered = {}, found.to_pylist()
        for kind, dtype in ((_RUN, "<f4"), (_WORD, "<f8")):
            rows = [r for r in answered if r["kind"] == kind]
            keys = np.concatenate([np.zeros(0, U64), *[unpacked(r["keys"], "<u8") for r in rows]])
            lookups[kind] = Lookup(keys, np.concatenate([np.zeros(0, dtype), *[unpacked(r["answers"], dtype) for r in rows]]))
        ids, columns = [], [[] for _ in range(4)]
        for batch in table.to_batches():
            for piece in pieces(batch, "text", PIECE_BYTES):
                codes, at, w = runs(piece.column("text"))
                texts = len(at) - 1
                owner, of_word = np.repeat(np.arange(texts), np.diff(at)), np.repeat(np.arange(texts), np.diff(w.bounds))
                known = lookups[_WORD](w.hash)
                smooth = lambda c: np.log10((c + 0.1) / (n + 0.1 * (v + 1)))
                ids.append(piece.column("doc_id"))
                columns[0].append(np.diff(w.bounds) + 1)
                columns[1].append(np.bincount(of_word, known > 0, texts).astype(np.int64) + (taught > 0))
                columns[2].append(np.bincount(of_word, smooth(known), texts) + smooth(float(taught)))
                columns[3].append(np.bincount(owner, lookups[_RUN](codes).astype(np.float64), texts))
        n_tokens, n_known, base, total = (np.concatenate(c) for c in columns)
        return pa.Table.from_arrays([pa.chunked_array(ids, pa.int64()), n_tokens, n_known, np.full(len(base), n), base, total], [c.split()[0] for c in result.split(", ")])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, result)
