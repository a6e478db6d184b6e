"""Near-duplicate groups by a multi-index Hamming join of min-hash signatures.

A document is the set of its word shingles. Equal sets form a class, and one row per class goes on. Its signature has 128
positions of 16 bits. The first 64 are cut into 14 chunks: if two signatures differ in at most 27 of them, then by the
pigeonhole principle some chunk differs in at most one position, so leaving out each position of a chunk in turn makes an index
key that both share. Every pair within that distance is found. At a similarity of 0.8 a pair lies beyond it, or beyond 45 of all
128 positions, once in about 40,000 cases. A longer sketch used in the
last round adds another such chance.

Only links between different components matter for the groups, so they are confirmed in rounds: with the first document of each
index group, with the one that is nearest to all the group, with the one nearest to the document, and then with all that are left in
other components. The last round has no bound on partners; the others only make it small. Links are confirmed on the full sets.

Rows with a null, empty or blank text have no set and are linked with nothing. A row with a null doc_id takes part in no group
(null component, kept). Repeated rows are one class; a doc_id is taken to be one document. No texts give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressroom.llm.words import U64, constants, mix, pieces, release, shingles, split_words
from pressroom.operators.components import connected_components
from pressroom.session import bounded_broadcast, materialize

POSITIONS, INDEXED, CHUNKS = 128, 64, 14
INDEX_DISTANCE, DISTANCE = 2 * CHUNKS - 1, 45
#: A longer sketch of 8-bit positions tells, in the last round, which pairs of other components are worth a look at their full sets.
SKETCH, SKETCH_DISTANCE = 512, 141
#: Members of an index group that one piece of work compares with as many others; larger groups are cut.
BLOCK = 1024
#: Pairs whose longer sketches are compared at once.
RUN = 4096

_SEEDS = constants(7, POSITIONS)
_SKETCH_SEEDS = constants(9, SKETCH)
_CHUNK = np.array_split(np.arange(INDEXED), CHUNKS)
_KEY_SEEDS = constants(8, INDEXED)


def _sets(n: int, column: str) -> Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, int]]]:
    def each(batch):
        at = 0
        for piece in pieces(batch, column, 1 << 20):
            values, bounds = shingles(split_words(piece.column(column)), n)
            yield values, bounds, at
            at += piece.num_rows

    return each


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def set_features(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set and signature (both null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.zeros(batch.num_rows, np.int64)
            digests, signatures = [None] * batch.num_rows, [None] * batch.num_rows
            for values, bounds, at in _sets(n, "text")(batch):
                filled = np.flatnonzero(np.diff(bounds))
                if not len(filled):
                    continue
                least = np.empty((len(filled), POSITIONS), np.uint16)
                for k, seed in enumerate(_SEEDS):
                    least[:, k] = np.minimum.reduceat(values * seed, bounds[:-1][filled]) & U64(0xFFFF)
                for row, i in zip(least, filled, strict=True):
                    own = np.unique(values[bounds[i] : bounds[i + 1]])
                    sizes[at + i] = len(own)
                    digests[at + i] = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                    signatures[at + i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
                ["doc_id", "n_shingles", "digest", "signature"],
            )
        release()

    return _texts(docs).mapInArrow(run, "doc_id bigint, n_shingles bigint, digest binary, signature binary")


def index_keys(classes: DataFrame) -> DataFrame:
    """(key, id, slot): for every chunk and every position left out of it, a hash of the others; the position is the slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, POSITIONS)
            spread = mix(rows[:, :INDEXED].astype(U64) + U64(1)) * _KEY_SEEDS
            keys = np.empty((len(rows), INDEXED), U64)
            for chunk in _CHUNK:
                keys[:, chunk] = mix(spread[:, chunk].sum(axis=1, dtype=U64)[:, None] - spread[:, chunk] + _KEY_SEEDS[chunk])
            ids, slots = np.repeat(batch.column("id").to_numpy(), INDEXED), np.tile(np.arange(INDEXED, dtype=np.int8), len(rows))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), pa.array(ids), pa.array(slots)], ["key", "id", "slot"])

    return classes.select("id", "signature").mapInArrow(run, "key bigint, id bigint, slot tinyint")


def sketches(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(id, sketch) of the documents with the given ids; one row an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values, bounds, at in _sets(n, "text")(batch):
                filled = np.flatnonzero(np.diff(bounds))
                if len(filled):
                    low = [(np.minimum.reduceat(values * s, bounds[:-1][filled]) & U64(0xFF)).astype(np.uint8) for s in _SKETCH_SEEDS]
                    rows = [r.tobytes() for r in np.stack(low, 1)]
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(filled + at)), pa.array(rows, pa.binary())], ["id", "sketch"])
        release()

    texts = _texts(docs).join(bounded_broadcast(ids.select(F.col("id").alias("doc_id"))), "doc_id", "left_semi")
    return texts.mapInArrow(run, "id bigint, sketch binary").dropDuplicates(["id"])


def within(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distance of signatures over all positions, or more than any allowed where the indexed ones differ too much."""
    differ = x != y
    total = differ.sum(axis=-1)
    return np.where(differ[..., :INDEXED].sum(axis=-1) > INDEX_DISTANCE, POSITIONS + 1, total)


@F.pandas_udf(T.IntegerType())
def signature_distance(a, b):
    import pandas as pd

    if not len(a):
        return pd.Series([], dtype="int32")
    x, y = (np.frombuffer(b"".join(s), np.uint16).reshape(-1, POSITIONS) for s in (a, b))
    return pd.Series(within(x, y).astype(np.int32))


def first_shared_slot(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The first slot whose key both signatures of each row have: where a chunk is equal its first, where it differs once that one."""
    found = np.full(len(x), INDEXED)
    for chunk in reversed(_CHUNK):
        differ = x[:, chunk] != y[:, chunk]
        n = differ.sum(axis=1)
        found = np.where(n == 0, chunk[0], np.where(n == 1, chunk[0] + differ.argmax(axis=1), found))
    return found


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``within`` for all rows of ``x`` and all columns of ``y``, on the low bytes of signatures.

    Bytes agree by chance a little more often than whole positions, so no pair seems farther apart than it is.
    """
    far = np.zeros((len(x), y.shape[1]), np.uint8)
    for k in range(POSITIONS):
        far += (x[:, k, None] != y[k]).view(np.uint8)
        if k + 1 == INDEXED:
            beyond = far > INDEX_DISTANCE
    far[beyond] = POSITIONS + 1
    return far


def mixed_groups(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, id, slot, component, blocks): members of the index groups that span several components."""
    at = members.join(labels, "id", "left").select("key", "id", "slot", F.coalesce("component", "id").alias("component"))
    ends = at.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    return at.join(ends.where("low != high").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "key")


def cross_pairs(groups: DataFrame, traits: DataFrame, percent: int, partner: str) -> DataFrame:
    """Distinct pairs of an index group that lie in different components, within the distance, and near enough in size.

    ``traits`` has signature and n_shingles of each id, and sketch where all partners are asked for; of the partners of a
    member in a piece of a group "central" takes the one that is nearest to all, "nearest" the one nearest to the member. A large group is cut into blocks, and each pair of blocks is a piece of its own.
    """
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = groups.select("key", "id", "slot", "component", "blocks", block.alias("own"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.select("key", "id", "slot", "component", "own", other.alias("other")).select(
        "key", "id", "slot", "component", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")
    )
    rows = placed.join(traits, "id").repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")

    def of_piece(part, x, y):
        ids, components, own, sizes, signatures = (part[c] for c in ("id", "component", "own", "n_shingles", "signature"))
        left, right = (np.flatnonzero(own == x), np.flatnonzero(own == y)) if x != y else (np.arange(len(ids)),) * 2
        out = []
        columns = np.ascontiguousarray(signatures[right].T)
        if not len(left) or not len(right):
            return np.zeros((0, 2), np.int64)
        if partner == "central":  # nothing but the centre is compared
            centre = int(distances(signatures[left[:128]], columns).sum(axis=0, dtype=np.int64).argmin())
            right, columns = right[[centre]], columns[:, [centre]]
        for low in range(0, len(left), 128):
            i = left[low : low + 128]
            far = distances(signatures[i], columns)
            small, large = np.minimum(sizes[i][:, None], sizes[right]), np.maximum(sizes[i][:, None], sizes[right])
            far[(components[i][:, None] == components[right]) | (100 * small < percent * large)] = POSITIONS + 1
            if partner != "all":
                p = np.arange(len(i))
                q = far.argmin(axis=1) if partner == "nearest" else np.zeros(len(i), np.int64)
                p, q = p[far[p, q] <= DISTANCE], q[far[p, q] <= DISTANCE]
            else:
                p, q = np.nonzero(far <= DISTANCE)
                kept = [(p[:0], q[:0])]
                for at in range(0, len(p), RUN):
                    x, y = p[at : at + RUN], q[at : at + RUN]
                    # a pair of several groups is reported by the first of them
                    once = first_shared_slot(part["whole"][i[x]], part["whole"][right[y]]) == part["slot"][0]
                    x, y = x[once], y[once]
                    sure = (part["sketch"][i[x]] != part["sketch"][right[y]]).sum(axis=1) <= SKETCH_DISTANCE
                    kept.append((x[sure], y[sure]))
                p, q = (np.concatenate(c) for c in zip(*kept, strict=True))
            out.append(np.stack([ids[i[p]], ids[right[q]]], 1))
        pairs = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
        return np.unique(np.sort(pairs, axis=1), axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> pa.RecordBatch:
            cols = {c: table.column(c).to_numpy() for c in ("key", "id", "slot", "component", "own", "x", "y", "n_shingles")}
            whole = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, POSITIONS)
            cols["signature"] = whole.astype(np.uint8)
            if partner == "all":
                cols["whole"] = whole[:, :INDEXED]
                cols["sketch"] = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
            change = np.flatnonzero(np.diff(cols["key"]) | np.diff(cols["x"]) | np.diff(cols["y"])) + 1
            found = [np.zeros((0, 2), np.int64)]
            for a, b in zip([0, *change], [*change, table.num_rows], strict=True):
                if b - a > 1:
                    found.append(of_piece({c: v[a:b] for c, v in cols.items()}, cols["x"][a], cols["y"][a]))
            pairs = np.concatenate(found)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            table = pa.Table.from_batches(waiting)
            last = [table.column(c)[-1].as_py() for c in ("key", "x", "y")]
            same = np.ones(table.num_rows, bool)
            for c, v in zip(("key", "x", "y"), last, strict=True):
                same &= table.column(c).to_numpy() == v
            cut = table.num_rows - int(same.sum())
            if cut:  # the last piece may go on in the next batch
                yield done(table.slice(0, cut).combine_chunks())
                waiting = table.slice(cut).combine_chunks().to_batches()
        if waiting:
            yield done(pa.Table.from_batches(waiting).combine_chunks())
        waiting.clear()
        release()

    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough: 100 * |a and b| >= percent * |a or b|."""
    ids = materialize(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    texts = _texts(docs).join(bounded_broadcast(ids), "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for values, bounds, at in _sets(n, "text")(batch):
                own = [np.unique(values[a:b]).view(np.int64) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)
                flat = np.concatenate([*own, np.zeros(0, np.int64)])
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(own)), pa.ListArray.from_arrays(offsets, flat)], ["id", "members"])
        release()

    # a repeated document, or one whose id has several texts, counts once: with the set of its class
    sets = texts.mapInArrow(run, "id bigint, members array<bigint>")
    sets = materialize(sets.join(classes.select("id", "n_shingles"), "id").where(F.size("members") == F.col("n_shingles")).dropDuplicates(["id"]))
    a = sets.select(F.col("id").alias("a"), F.col("members").alias("in_a"))
    b = sets.select(F.col("id").alias("b"), F.col("members").alias("in_b"))
    shared = F.size(F.array_intersect("in_a", "in_b")).cast("bigint")
    both = pairs.join(b, "b").join(a, "a")
    either = F.size("in_a").cast("bigint") + F.size("in_b") - shared
    return both.where(100 * shared >= percent * either).select("a", "b")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links) and kept, one row per document.

    ``percent`` is 80 or more: the distances are those of such pairs.
    Links join documents with 100 * |intersection| >= percent * |union| of their sets of ``words``-word shingles.
    """
    if percent < 80:
        raise ValueError("the index finds pairs of 80 percent and more")
    features = materialize(set_features(docs, words))
    classes = materialize(
        features.where("digest is not null and doc_id is not null").groupBy("digest")
        .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    )
    keys = index_keys(classes)
    hubs = keys.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub != last").select("key", "hub")
    members = materialize(keys.join(hubs, "key"))

    # first round: the first document of the group, and of several such the nearest
    a = classes.select(F.col("id").alias("a"), F.col("signature").alias("sa"))
    b = classes.select(F.col("id").alias("b"), F.col("signature").alias("sb"))
    first = members.where("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    first = first.join(a, "a").join(b, "b").select("a", "b", signature_distance("sa", "sb").alias("d")).where(F.col("d") <= DISTANCE)
    tested = materialize(first.groupBy("b").agg(F.min(F.struct("d", "a")).alias("best")).select("best.a", "b"))
    edges = materialize(confirmed(tested, docs, classes, words, percent))
    labels = connected_components(edges)

    traits = classes.select("id", "signature", "n_shingles")
    for partner in ("central", "nearest", "all"):
        groups = materialize(mixed_groups(members, labels))
        if partner == "all":
            traits = traits.join(sketches(docs, materialize(groups.select("id").distinct()), words), "id")
        more = materialize(cross_pairs(groups, traits, percent, partner))
        found = materialize(confirmed(more, docs, classes, words, percent))
        if not found.isEmpty():
            edges = edges.unionByName(found)
            labels = connected_components(edges)

    of_class = classes.join(labels, "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    component = F.coalesce("component", "doc_id")
    return features.join(of_class, "digest", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        (F.col("doc_id").isNull() | (component == F.col("doc_id"))).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document, with its columns, of each group of near duplicates: the one with the smallest doc_id.

    Of rows that repeat a doc_id one stays; rows without doc_id all stay.
    """
    groups = near_duplicates(docs, words, percent).where("kept and doc_id is not null")
    kept = materialize(groups.groupBy(F.col("doc_id").alias("_kept")).agg(F.count("*").alias("_rows")))
    same = F.col("doc_id").cast("bigint") == F.col("_kept")
    single = docs.join(bounded_broadcast(kept.where("_rows = 1").select("_kept")), same, "left_semi")
    repeated = docs.join(bounded_broadcast(kept.where("_rows > 1").select("_kept")), same, "left_semi").dropDuplicates(["doc_id"])
    return single.unionByName(repeated).unionByName(docs.where("doc_id is null"))
