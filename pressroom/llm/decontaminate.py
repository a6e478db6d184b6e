"""Benchmark decontamination: rare n-gram seeds, then local alignment.

A document is contaminated by an item if the best local alignment of their words (Smith-Waterman: match 2, other word -1, gap -1), which copes
with words changed, left out or put in, scores ``threshold`` of the whole item's score or more. Seeds lose none of these: an alignment that good of
an item of L words keeps at least (2 * threshold - 1) * L - 1 pairs of neighbouring words, all within (3 - 2 * threshold) * L words of the
document. So with n-grams counted over all documents, the item's rarest pairs, all but one fewer than it must keep, are its seeds: a stretch of
a document is aligned with an item if it holds a seed and as many of the item's pairs as must be kept. Items so short that no pair need be kept
(five words, at 0.6) seed by single words in the same way. Stock phrases and items copied into a third of all documents are no exceptions.

Words are as in ``words``. Items go to the tasks in parts of a bounded number of words, each part two passes over the documents, so a benchmark
of any size is covered; documents stay where they lie. Null or blank texts match nothing; rows with a null id take no part; repeated rows
give the same finding once; an item_id with several texts has the best finding of any. Documents
without a match, or an empty table on either side, give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pressroom.llm.words import pieces, release, shingles, split_words
from pressroom.session import bounded_broadcast, materialize

#: Places of item n-grams in documents that a task holds at once.
PLACES = 1_000_000
#: Words of test items that one pass holds in each task.
PART_WORDS = 500_000
MATCH, OTHER, GAP = 2, -1, -1
#: Cells of an alignment batch (pairs x window x item), bounding a task's memory.
CELLS = 4_000_000
MATCHES = "doc_id bigint, item_id bigint, score bigint, coverage double, first_word bigint, last_word bigint"


def local_alignment(windows: list[np.ndarray], items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each pair of word sequences, and the window's word after its end.

    Rows of the score table are filled for all pairs at once; a gap along the row is a running maximum.
    """
    n, wide, long = len(windows), max(map(len, items)), max(map(len, windows))
    w, x = np.zeros((n, long), np.int64), np.zeros((n, wide), np.int64)
    for i, (a, b) in enumerate(zip(windows, items, strict=True)):
        w[i, : len(a)], x[i, : len(b)] = a.view(np.int64), b.view(np.int64)
    valid_w = np.arange(long) < np.array([len(a) for a in windows])[:, None]
    valid_x = np.arange(wide) < np.array([len(b) for b in items])[:, None]
    row = np.zeros((n, wide + 1), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    slope = np.arange(wide + 1, dtype=np.int32) * -GAP
    for t in range(long):
        gain = np.where((w[:, t : t + 1] == x) & valid_x & valid_w[:, t : t + 1], MATCH, OTHER)
        new = np.zeros_like(row)
        new[:, 1:] = np.maximum(row[:, :-1] + gain, row[:, 1:] + GAP)
        np.maximum(new, 0, out=new)
        new = np.maximum.accumulate(new + slope, axis=1) - slope
        row = new
        top = row.max(axis=1)
        better = top > best
        best[better], end[better] = top[better], t + 1
    return best, end


def _parts(benchmark: DataFrame) -> list[int]:
    """Numbers of the parts of the benchmark, by running word counts over its rows (``_part`` of ``_with_parts``)."""
    return [r[0] for r in benchmark.select("_part").distinct().orderBy("_part").collect()]


def _with_parts(benchmark: DataFrame) -> DataFrame:
    """item_id and text with a part number such that a part has about PART_WORDS words."""
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-int(total) // (4 * PART_WORDS)))  # about four bytes a word at least
    return items.withColumn("_part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).cast("int"))


@dataclass
class Seeds:
    """The n-grams of the items that seed by ``n`` words, as sorted distinct hashes and the items of each."""

    n: int
    grams: np.ndarray  # sorted
    keys: np.ndarray  # sorted: place in grams * items + item
    counts: np.ndarray  # how often that item has that n-gram
    items: int
    total: np.ndarray  # n-grams of each item
    least: np.ndarray  # of each item, the n-grams that an alignment over the threshold keeps; 0 if it seeds by another n
    span: np.ndarray  # and the words of a document that they lie within
    rare: np.ndarray  # of each key, whether it is a seed
    places: int

    def found(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the values are n-grams of items, and which."""
        place = np.minimum(np.searchsorted(self.grams, values), len(self.grams) - 1)
        where = np.flatnonzero(self.grams[place] == values)
        return where, place[where]

    def choose(self, frequency: np.ndarray) -> None:
        """Make the rarest n-grams of every item its seeds: without them it has one too few to keep."""
        gram, item = np.divmod(self.keys, self.items)
        order = np.lexsort((self.keys, frequency[gram], item))
        counts = self.counts[order]
        before = np.cumsum(counts) - counts
        first = np.searchsorted(item[order], np.arange(self.items))
        rank = before - before[np.minimum(first, len(before) - 1)][item[order]]
        self.rare = np.empty(len(self.keys), bool)
        self.rare[order] = rank < (self.total - self.least + 1)[item[order]]

    def stretches(self, gram: np.ndarray, doc: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(doc, item, low, high) of the words in which an alignment over the threshold may lie; ``doc`` and ``at`` ascend."""
        blocks = [(0, self.items)]
        while blocks:
            low, high = blocks.pop()
            a = np.searchsorted(self.keys, gram * self.items + low)
            many = np.searchsorted(self.keys, gram * self.items + high) - a
            total = int(many.sum())
            if total > self.places and high - low > 1:
                blocks += [(low, (low + high) // 2), ((low + high) // 2, high)]
            elif total:
                entry = np.arange(total) - np.repeat(np.cumsum(many) - many, many) + np.repeat(a, many)
                yield from self._dense(self.keys[entry] % self.items, np.repeat(doc, many), np.repeat(at, many), self.rare[entry])

    def _dense(self, item: np.ndarray, doc: np.ndarray, at: np.ndarray, rare: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        order = np.lexsort((at, item, doc))
        item, doc, at, seeds = item[order], doc[order], at[order], np.concatenate([[0], np.cumsum(rare[order])])
        group = np.cumsum(np.concatenate([[0], (np.diff(item) != 0) | (np.diff(doc) != 0)]))
        wide = int(at.max() + self.span.max()) + 1
        line = group * wide + at
        last = np.searchsorted(line, line + self.span[item], "right")
        i = np.flatnonzero((last - np.arange(len(line)) >= self.least[item]) & (seeds[last] > seeds[:-1]))
        if not len(i):
            return
        reach = self.span[item[i]] + self.n
        low, high, of = np.maximum(at[i] - reach, 0), at[last[i] - 1] + reach, group[i]
        cuts = np.flatnonzero((of[1:] != of[:-1]) | (low[1:] > high[:-1])) + 1  # both ends ascend within a group
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(i)], strict=True):
            yield int(doc[i[a]]), int(item[i[a]]), int(low[a]), int(high[b - 1])


def _seeds(words, threshold: float) -> list[Seeds]:
    """Seeds by pairs of words, and by single words for the items that need keep no pair."""
    size = np.diff(words.bounds)
    pairs = np.ceil((2 * threshold - 1) * size - 1 - 1e-9).astype(np.int64)
    out = []
    for n, least in ((2, np.where(pairs > 0, pairs, 0)), (1, np.where(pairs > 0, 0, np.ceil(threshold * size - 1e-9).astype(np.int64)))):
        values, bounds = shingles(words, n)
        item = np.repeat(np.arange(len(size)), np.diff(bounds))
        own = least[item] > 0
        if own.any():
            grams = np.unique(values[own])
            keys, counts = np.unique(np.searchsorted(grams, values[own]) * len(size) + item[own], return_counts=True)
            span = np.ceil((3 - 2 * threshold) * size).astype(np.int64)
            out.append(Seeds(n, grams, keys, counts, len(size), np.diff(bounds), least, span, np.zeros(len(keys), bool), PLACES))
    return out


def _frequencies(docs: DataFrame, seeds: list[Seeds]) -> list[np.ndarray]:
    """In how many rows every n-gram stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(s.grams), np.int64) for s in seeds]
        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                words = split_words(piece.column("text"))
                for s, n in zip(seeds, counts, strict=True):
                    values, bounds = shingles(words, s.n)
                    where, place = s.found(values)
                    doc = np.searchsorted(bounds, where, "right") - 1
                    n += np.bincount(np.unique(doc * len(s.grams) + place) % len(s.grams), minlength=len(n))
        for k, n in enumerate(counts):
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k, np.int32)), pa.array(some), pa.array(n[some])], ["k", "place", "n"])
        release()

    totals = docs.select("text").mapInArrow(run, "k int, place bigint, n bigint").groupBy("k", "place").agg(F.sum("n").alias("n")).toArrow()
    out = [np.zeros(len(s.grams), np.int64) for s in seeds]  # as many as the part has n-grams
    k, place, n = (totals.column(c).to_numpy() for c in ("k", "place", "n"))
    for i, counts in enumerate(out):
        counts[place[k == i]] = n[k == i]
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6) -> DataFrame:
    """doc_id, item_id, score, coverage and the words (from first_word up to last_word) of every contaminated document and item."""
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = materialize(_with_parts(benchmark))
    out = None
    for part in _parts(items):
        rows = items.where(F.col("_part") == part).select("item_id", "text").distinct().collect()  # bounded by PART_WORDS
        found = _contaminated_by(texts, [(r[0], r[1]) for r in rows], threshold)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], MATCHES)
    best = W.partitionBy("doc_id", "item_id").orderBy(F.desc("coverage"), "first_word", "last_word")
    return out.withColumn("_r", F.row_number().over(best)).where("_r = 1").drop("_r")


def _contaminated_by(texts: DataFrame, rows: list[tuple[int, str]], threshold: float) -> DataFrame:
    words = split_words(pa.array([t for _, t in rows], pa.string()))
    seeds = _seeds(words, threshold)
    if not seeds:
        return texts.sparkSession.createDataFrame([], MATCHES)
    for s, frequency in zip(seeds, _frequencies(texts, seeds), strict=True):
        s.choose(frequency)
    own = [words.hash[words.bounds[i] : words.bounds[i + 1]] for i in range(len(rows))]
    ids = [r[0] for r in rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        jobs: list[tuple[int, int, int, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            best: dict[tuple[int, int], tuple] = {}
            jobs.sort(key=lambda j: len(j[3]))
            a = 0
            while a < len(jobs):
                b, wide = a, 0
                while b < len(jobs):
                    wide = max(wide, len(jobs[b][4]))
                    if b > a and (b + 1 - a) * max(wide, len(jobs[b][3])) * 8 > CELLS:
                        break
                    b += 1
                score, end = local_alignment([j[3] for j in jobs[a:b]], [j[4] for j in jobs[a:b]])
                for (doc, item, low, _, x), s, e in zip(jobs[a:b], score.tolist(), end.tolist(), strict=True):
                    share = s / (MATCH * len(x))
                    found = (s, share, max(low, low + e - len(x)), low + e)
                    if share >= threshold and found > best.get((doc, item), (0,)):
                        best[doc, item] = found
                a = b
            jobs.clear()
            lists = list(zip(*[(d, ids[i], *f) for (d, i), f in best.items()], strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip(lists, kinds, strict=True)], [c.split()[0] for c in MATCHES.split(", ")])

        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                w = split_words(piece.column("text"))
                docs = piece.column("doc_id").to_pylist()
                for s in seeds:
                    values, bounds = shingles(w, s.n)
                    where, gram = s.found(values)
                    doc = np.searchsorted(bounds, where, "right") - 1
                    for i, item, low, high in s.stretches(gram, doc, where - bounds[doc]):
                        seq = w.hash[w.bounds[i] : w.bounds[i + 1]][low:high]
                        jobs.append((docs[i], item, low, seq, own[item]))
                yield flush()
        release()

    return texts.mapInArrow(run, MATCHES)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6) -> DataFrame:
    """The documents, with their columns, that no test item contaminates; rows without doc_id stay."""
    found = materialize(contaminated(docs, benchmark, threshold).select(F.col("doc_id").alias("_found")).distinct())
    return docs.join(bounded_broadcast(found), F.col("doc_id").cast("bigint") == F.col("_found"), "left_anti")
