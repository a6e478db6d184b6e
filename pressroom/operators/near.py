"""Pairs of near-duplicate texts, for canonical articles: banded min-hash buckets, then a prefix join where a bucket is mixed.

A text is the set of its runs of ``words`` words (a shorter text is one run), ASCII capitals lowered; texts without words match
nothing. Links are enough to reach every near duplicate, they are not all pairs. They come in steps, each verified on full sets, with what is
connected so far contracted in between:

1. Of texts with equal sets each is linked to the smallest id.
2. Each text is compared with the first text of one bucket, the one it shares most buckets with. That joins a group of copies, however large.
3. Buckets that still span several components are not compared member by member: a bucket of boilerplate may hold a third of all texts and
   no near duplicate. The texts in at least SHARED such buckets go through an exact set-similarity join instead. Their shingles are put in one order, by the
   number of texts that have them. Two sets that are similar enough share a shingle among the first few of each, how few depends on both
   sizes; so a set is filed under its first shingles once for each class of sizes its partner can have. What boilerplate has in common comes
   last in the order, and is filed only where the boilerplate is nearly all of a text, and then the texts are near duplicates.
   Of a shingle that several components share, first neighbouring components are compared by one text each, twice; then, among what is still
   apart, all texts of different components. Large groups are cut into blocks, each pair of blocks is a key of its own.

One pass over the texts leaves band keys only; sets are made again for texts of candidate pairs.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pressroom.operators.components import connected_components
from pressroom.session import bounded_broadcast, materialize

#: 128 hashes; a pair at a similarity of 0.8 shares fewer than SHARED bands with a probability of 1.1e-6, one above it less.
BANDS, ROWS, SHARED = 32, 4, 2
#: Texts and shingles taken at once in a task, but for a single longer text; word hashes remembered.
TEXTS, PIECE, REMEMBERED = 256, 1 << 18, 1 << 18
_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
_WORD = re.compile(rb"[^ \x09-\x0D]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Texts of one size class differ by less than this factor; texts of a block.
CLASS, BLOCK = 1.12, 512


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


def shingle_set(text: str, words: int, hashes: _Hashes) -> np.ndarray:
    """Ascending 64-bit hashes of the distinct runs of ``words`` words."""
    found = _WORD.findall(text.encode().translate(_LOWER))
    word = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    length = min(words, len(word))
    runs = np.full(max(len(word) - length + 1, 0) if length else 0, np.uint64(length))
    for k in range(length):
        runs = (runs ^ word[k : k + len(runs)]) * _MIX
        runs ^= runs >> np.uint64(32)
    return np.unique(runs)


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """(ids, sets) of texts with words, in pieces."""
    hashes = _Hashes()
    for batch in batches:
        ids: list[int] = []
        sets: list[np.ndarray] = []
        size = 0
        for at in range(0, batch.num_rows, TEXTS):
            for i, text in enumerate(batch.column("text").slice(at, TEXTS).to_pylist(), at):
                found = shingle_set(text, words, hashes)
                if not len(found):
                    continue
                ids.append(i)
                sets.append(found)
                size += len(found)
                if size >= PIECE:
                    yield batch.column("id").take(pa.array(ids)), sets
                    ids, sets, size = [], [], 0
        if ids:
            yield batch.column("id").take(pa.array(ids)), sets


def _lists(values: np.ndarray, sizes: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values.view(np.int64)))


@lru_cache(1 << 16)
def size_class(n: int) -> int:
    return int(math.log(n) / math.log(CLASS))


@lru_cache(1 << 16)
def _least_of(size: int) -> int:
    """The smallest set size of a class."""
    n = max(1, math.ceil(CLASS**size) - 2)
    while size_class(n) < size:
        n += 1
    while n > 1 and size_class(n - 1) >= size:
        n -= 1
    return n


@lru_cache(1 << 16)
def prefixes(n: int, percent: int) -> list[tuple[int, int]]:
    """(class, length): how many of its first shingles a set of ``n`` has to be filed under for partners of each class of sizes."""
    low, high = -(-percent * n // 100), 100 * n // percent
    out = []
    for size in range(size_class(low), size_class(high) + 1):
        partner = max(low, _least_of(size))
        if partner <= high:
            out.append((size, n - -(-percent * (n + partner) // (100 + percent)) + 1))
    return out


def near_links(articles: DataFrame, article_id: str = "article_id", text: Column | str = "text", words: int = 4, percent: int = 80) -> DataFrame:
    """(a, b) with a < b: verified pairs of a Jaccard similarity of ``percent`` or more, from which all others can be reached."""
    text = F.col(text) if isinstance(text, str) else text
    texts = articles.select(F.col(article_id).alias("id"), text.alias("text")).where("id is not null and text is not null")
    kind = texts.schema["id"].dataType.simpleString()

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(11)
        odd = rng.integers(0, 1 << 63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
        flip = rng.integers(0, 1 << 63, (BANDS, ROWS), np.uint64)
        for ids, sets in _sets(batches, words):
            sizes = [len(x) for x in sets]
            values = np.concatenate(sets)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
            keys = np.empty((len(sets), BANDS), np.uint64)
            for band in range(BANDS):
                key = np.full(len(sets), np.uint64(band))
                for k in range(ROWS):
                    key = (key ^ np.minimum.reduceat((values ^ flip[band, k]) * odd[band, k], starts)) * _MIX
                    key ^= key >> np.uint64(32)
                keys[:, band] = key
            same = pa.array([hashlib.md5(x.tobytes()).digest() for x in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int32()), same, _lists(keys.ravel(), [BANDS] * len(sets))], ["id", "n", "key", "buckets"])

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _sets(batches, words):
            yield pa.RecordBatch.from_arrays([ids, _lists(np.concatenate(sets), [len(x) for x in sets])], ["id", "shingles"])

    def sets_of(ids: DataFrame) -> DataFrame:
        # repeated ids go while rows are texts, which pack well; sets of hashes do not
        rows = texts.join(bounded_broadcast(ids), "id", "left_semi").where(F.col("text").rlike(r"[^ \x09-\x0D]")).dropDuplicates(["id"])
        return materialize(rows.mapInArrow(shingled, f"id {kind}, shingles array<bigint>"))

    def verified(pairs: DataFrame, sets: DataFrame | None = None) -> DataFrame:
        pairs = materialize(pairs)
        if sets is None:
            sets = sets_of(materialize(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()))
        left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("_a"))
        right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", F.size("_a").alias("_m"), F.size("_b").alias("_n"), F.size(F.array_intersect("_a", "_b")).alias("_both"))
        return both.where(F.col("_both") * 100 >= (F.col("_m") + F.col("_n") - F.col("_both")) * percent).select("a", "b").distinct()

    def filed(sets: DataFrame) -> DataFrame:
        """(key, id) of the first shingles of every set. Shingles of a single text come first in the order; they are counted, not filed."""
        each = sets.select("id", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
        counts = each.groupBy("shingle").agg(F.count("*").alias("texts")).where("texts > 1")
        shared = each.join(counts, "shingle").groupBy("id").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("texts", "shingle"))).alias("shared"))
        shared = shared.select("id", "n", F.col("shared.shingle").alias("shingles"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, TEXTS):
                    part = batch.slice(at, TEXTS)
                    keys: list[np.ndarray] = []
                    for n, own in zip(part.column("n").to_pylist(), part.column("shingles"), strict=True):
                        ranked = own.values.to_numpy().view(np.uint64)
                        alone, mine = n - len(ranked), size_class(n)
                        made = [
                            (ranked[: length - alone] ^ np.uint64(min(size, mine) << 20 | max(size, mine))) * _MIX
                            for size, length in prefixes(n, percent) if length > alone
                        ]
                        keys.append(np.concatenate([*made, np.zeros(0, np.uint64)]))
                    sizes = [len(x) for x in keys]
                    ids = part.column("id").take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
                    flat = np.concatenate([*keys, np.zeros(0, np.uint64)])
                    yield pa.RecordBatch.from_arrays([pa.array((flat ^ flat >> np.uint64(32)).view(np.int64)), ids], ["key", "id"])

        return shared.mapInArrow(run, f"key bigint, id {kind}")

    def apart(keys: DataFrame, found: DataFrame) -> DataFrame:
        """(key, id, component) of the keys that several components have in common."""
        labelled = keys.join(connected_components(found), "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
        ends = labelled.groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count("*").alias("_n"))
        return labelled.join(ends.where("_low != _high").select("key", F.ceil(F.col("_n") / BLOCK).cast("int").alias("blocks")), "key")

    def neighbours(members: DataFrame, pick) -> DataFrame:
        """One text of each component of a key with one of the next component."""
        each = members.groupBy("key", "component").agg(pick("id").alias("id"))
        after = F.lead("id").over(W.partitionBy("key").orderBy("component"))
        return each.select(F.col("id").alias("_x"), after.alias("_y")).where("_y is not null")

    def across(members: DataFrame) -> DataFrame:
        """All texts of different components of a key."""
        own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
        placed = members.select("key", "id", "component", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        placed = placed.select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "id", "component", "own")
        other = placed.select("key", "x", "y", F.col("id").alias("_y"), F.col("component").alias("_component"), F.col("own").alias("_own"))
        return placed.withColumnRenamed("id", "_x").join(other, ["key", "x", "y"]).where("_x < _y and component != _component and (x = y or own != _own)").select("_x", "_y")

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b")).distinct()

    def alike(n: str, m: str) -> Column:
        return F.least(n, m).cast("bigint") * 100 >= F.greatest(n, m).cast("bigint") * percent

    sets = materialize(texts.mapInArrow(banded, f"id {kind}, n int, key binary, buckets array<bigint>"))
    first = materialize(sets.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")))
    equal = sets.select("key", "id").join(first.where("a < z"), "key").where("id != a").select("a", F.col("id").alias("b"))
    single = sets.join(first.select("key", F.col("a").alias("id")), ["key", "id"], "left_semi")
    members = single.select(F.explode("buckets").alias("bucket"), "id", "n")
    shared = members.groupBy("bucket").agg(F.min(F.struct("id", "n")).alias("least"), F.max("id").alias("z")).where("least.id < z")
    members = materialize(members.join(bounded_broadcast(materialize(shared)), "bucket").select("bucket", "id", "n", "least"))
    star = members.where(F.col("id") != F.col("least.id")).where(alike("n", "least.n")).groupBy(F.col("least.id").alias("a"), F.col("id").alias("b")).count()
    star = star.groupBy("b").agg(F.max_by("a", F.struct("count", "a")).alias("a")).select("a", "b")
    links = materialize(equal.unionByName(verified(star)))
    # what is still apart in some bucket
    left = members.drop("least").join(connected_components(links), "id", "left").withColumn("component", F.coalesce("component", "id"))
    left = materialize(left)
    mixed = left.groupBy("bucket").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).where("_low != _high").select("bucket")
    shared = left.join(mixed, "bucket", "left_semi").groupBy("id").count().where(F.col("count") >= SHARED)
    sets = sets_of(materialize(shared.select("id")))
    members = materialize(filed(sets))
    for pick in (F.min, F.max, None):
        # a shingle of one component has only one later on
        members = materialize(apart(members.select("key", "id"), links))
        pairs = ordered(neighbours(members, pick) if pick else across(members))
        links = materialize(links.unionByName(verified(pairs, sets)))
    return links
