"""Nearest vectors by cosine: a coarse quantiser, inverted lists as a partitioned table, probes as an equi-join.

Centroids are learned by spherical k-means from a sample (about ``SAMPLE`` vectors of each length, chosen by a hash of the id), and every vector
is filed under its nearest centroid. A search sends each query to some lists and meets only what is filed there.

A search is *exact* without ``probes``. Its first round visits the nearest lists and yields the k-th best score so far. No vector of a list can be nearer
to a query than the angle to the centroid less the list's radius, so the second round visits the lists that could still hold a better
one, and no other. On vectors without any structure these are nearly all lists; on clustered ones few. With ``probes`` a search visits that
many lists; ``calibrated_probes`` finds how many give a wanted recall, from the exact answers of a few queries.

Lists are put together, or cut, into pieces of about ``PIECE`` vectors, and the queries of a piece are dealt into blocks of about ``BLOCK`` (fewer of vectors longer
than ``USUAL``), so a list that holds a third of all vectors, or that every query visits, is many small tasks. A piece is shuffled once for each block of its
queries, and a query once for each piece with a list it visits, so neither is small. Each list of a piece hands on its best ``k`` a query at most.

Vectors that are null, zero, or hold a null or no finite number take no part; a query meets only vectors of its own length. Scores are
rounded to 6 places, ties go to the smaller id. No vectors or no queries give no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from pressroom.session import bounded_broadcast, ensure_checkpoint_dir, materialize

SAMPLE = 16_384
#: Lists of each vector length at most; below it about the root of the number of vectors.
MAX_LISTS = 4096
PIECE, BLOCK, TOGETHER = 8192, 8192, 256
#: Fewer vectors than would fill so many pieces go to smaller ones, of so many at least, to keep all tasks busy.
SPREAD, LEAST = 64, 512
#: Length of vectors up to which pieces and blocks have as many; of longer ones they have as many numbers.
USUAL = 64
ROUNDS = 10
#: Lists of the first round of an exact search.
FIRST = 4
_PER_LENGTH = 1 << 20  # list numbers are length * this + the list's place


@dataclass
class Lists:
    """The lists of one vector length, as every task knows them."""

    numbers: np.ndarray
    centroids: np.ndarray
    radius: np.ndarray  # largest angle to a vector of the list
    sizes: np.ndarray


@dataclass
class VectorIndex:
    vectors: DataFrame  # list, id, v, n
    sizes: DataFrame  # list, size: one row a list
    lists: dict[int, Lists]
    article_id: str


def top(scored: DataFrame, k: int, article_id: str) -> DataFrame:
    best = W.partitionBy("query_id").orderBy(F.desc("score"), article_id)
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", article_id, "score")


def _clean(df: DataFrame, key: str, vector: str, name: str) -> DataFrame:
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    rows = df.select(F.col(key).alias(name), v.alias("v")).withColumn("n", norm)
    return rows.where((F.col("n") > 0) & (F.col("n") < float("inf")))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of one length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, unit vectors) of a batch."""
    lengths = np.diff(batch.column("v").offsets.to_numpy())
    norms = batch.column("n").to_numpy()
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield int(d), rows, _matrix(batch.column("v").take(pa.array(rows))) / norms[rows][:, None]


def _learn(table: pa.Table) -> pa.Table:
    """Centroids of the sample of one length; the same whatever order it comes in."""
    table = table.sort_by([("h", "ascending"), ("id", "ascending")])
    unit = _matrix(table.column("v")) / table.column("n").to_numpy()[:, None]
    count = min(len(unit), int(table.column("lists")[0].as_py()))
    centres = unit[:count]
    for _ in range(ROUNDS):
        own = np.concatenate([(unit[i : i + 4096] @ centres.T).argmax(1) for i in range(0, len(unit), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, unit)
        norms = np.linalg.norm(sums, axis=1)
        centres = np.where(norms[:, None] > 0, sums / np.maximum(norms, 1e-300)[:, None], centres)
    d = unit.shape[1]
    return pa.table({"d": pa.array([d] * count, pa.int32()), "place": pa.array(np.arange(count, dtype=np.int32)), "centroid": pa.array(list(centres), pa.list_(pa.float64()))})


def build_index(vectors: DataFrame, article_id: str = "article_id", vector: str = "embedding", lists: int | None = None, path: str | None = None) -> VectorIndex:
    """File the vectors; the table goes to ``path``, else to the checkpoint folder. ``lists`` is the number of lists of each length."""
    spark = vectors.sparkSession
    clean = _clean(vectors, article_id, vector, "id")
    kind = clean.schema["id"].dataType.simpleString()
    clean = clean.withColumns({"d": F.size("v"), "h": F.xxhash64("id")})
    counts = materialize(clean.groupBy("d").agg(F.count("*").alias("count")))  # one row a length
    wanted = F.least(F.lit(MAX_LISTS), F.ceil(F.sqrt("count"))) if lists is None else F.lit(lists)
    share = F.lit(2.0**32) * SAMPLE / F.col("count")
    chosen = clean.join(bounded_broadcast(counts.withColumn("lists", wanted.cast("int"))), "d").where(F.pmod("h", F.lit(1 << 32)) < share)
    learned = chosen.select("d", "h", "id", "v", "n", "lists").groupBy("d").applyInArrow(_learn, "d int, place int, centroid array<double>")
    centroids: dict[int, list] = {}
    for r in learned.orderBy("d", "place").collect():  # MAX_LISTS rows a length at most
        centroids.setdefault(r["d"], []).append(r["centroid"])
    matrices = {d: np.array(rows) for d, rows in centroids.items()}

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, unit in _by_length(batch):
                near = unit @ matrices[d].T
                place = near.argmax(1)
                angle = np.arccos(np.clip(near[np.arange(len(rows)), place], -1, 1))
                part = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place + d * _PER_LENGTH), *(part.column(c) for c in ("id", "v", "n")), pa.array(angle)], ["list", "id", "v", "n", "angle"]
                )

    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/lists-{uuid.uuid4().hex}"
    rows = clean.select("id", "v", "n").mapInArrow(filed, f"list bigint, id {kind}, v array<double>, n double, angle double")
    rows.hint("rebalance", "list").write.mode("overwrite").partitionBy("list").parquet(path)
    stored = spark.read.schema(f"id {kind}, v array<double>, n double, angle double, list bigint").parquet(path)
    sizes = materialize(stored.groupBy("list").agg(F.count("*").alias("size"), F.max("angle").alias("radius")))
    stats = {r["list"]: (r["radius"], r["size"]) for r in sizes.collect()}  # one row a list
    known = {}
    for d, matrix in matrices.items():
        places = [i for i in range(len(matrix)) if d * _PER_LENGTH + i in stats]
        numbers = np.array(places, np.int64) + d * _PER_LENGTH
        known[d] = Lists(numbers, matrix[places], *(np.array([stats[n][i] for n in numbers]) for i in (0, 1)))
    return VectorIndex(stored.select("list", "id", "v", "n"), sizes.select("list", "size"), known, article_id)


def _wanted(lists: Lists, unit: np.ndarray, kth: np.ndarray, probes: int, beyond: bool) -> tuple[np.ndarray, np.ndarray]:
    """The place of each list in the order of each query, and whether the query visits it."""
    near = unit @ lists.centroids.T
    order = np.argsort(-near, axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], 1)
    if not beyond:
        return place, place < probes
    bound = np.cos(np.maximum(np.arccos(np.clip(near, -1, 1)) - lists.radius, 0))
    return place, (place >= probes) & (bound >= kth[:, None] - 2e-6)


def _visits(index: VectorIndex, queries: DataFrame, probes: int, beyond: bool = False, all_lists: bool = False) -> DataFrame:
    """(list, place, query_id, v, n, kth): the ``probes`` nearest lists of each query, or with ``beyond`` the others that could hold a score of ``kth``."""
    lists = index.lists
    kind = queries.schema["query_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 1024) for b in batches for i in range(0, b.num_rows, 1024)):
            for d, rows, unit in _by_length(batch):
                if d not in lists:
                    continue
                place, wanted = _wanted(lists[d], unit, batch.column("kth").to_numpy()[rows], probes, beyond)
                q, at = np.nonzero(np.ones_like(wanted) if all_lists else wanted)
                part = batch.take(pa.array(rows[q]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists[d].numbers[at]), pa.array(place[q, at].astype(np.int32)), *(part.column(c) for c in ("query_id", "v", "n", "kth"))],
                    ["list", "place", "query_id", "v", "n", "kth"],
                )

    return queries.select("query_id", "v", "n", "kth").mapInArrow(run, f"list bigint, place int, query_id {kind}, v array<double>, n double, kth double")


def _dealt(length: int, lists: Lists) -> tuple[np.ndarray, np.ndarray]:
    """The first piece of each list, and how many it has: short lists share one, long ones have several."""
    room = max(min(PIECE, PIECE * USUAL // length, max(int(lists.sizes.sum()) // SPREAD, LEAST)), 1)
    pieces, first, last, filled = -(-lists.sizes // room), [], -1, room
    for size, count in zip(lists.sizes.tolist(), pieces.tolist(), strict=True):
        if filled + size > room:
            last, filled = last + 1, 0
        first.append(last)
        last, filled = last + count - 1, filled + size
    return np.array(first, np.int64) + length * _PER_LENGTH, pieces


def _calls(index: VectorIndex, queries: DataFrame, probes: int, beyond: bool = False) -> DataFrame:
    """(first, pieces, lists, query_id, v, n, kth): what a query visits, as in ``_visits``, in one row for all lists of a piece."""
    dealt = {d: (lists, *_dealt(d, lists)) for d, lists in index.lists.items()}
    kind = queries.schema["query_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 1024) for b in batches for i in range(0, b.num_rows, 1024)):
            for d, rows, unit in _by_length(batch):
                if d not in dealt:
                    continue
                lists, first, pieces = dealt[d]
                q, at = np.nonzero(_wanted(lists, unit, batch.column("kth").to_numpy()[rows], probes, beyond)[1])
                new = np.flatnonzero((np.diff(q, prepend=-1) != 0) | (np.diff(first[at], prepend=-1) != 0))
                part = batch.take(pa.array(rows[q[new]]))
                together = pa.ListArray.from_arrays(pa.array(np.append(new, len(q)).astype(np.int32)), pa.array(lists.numbers[at]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first[at[new]]), pa.array(pieces[at[new]].astype(np.int32)), together, *(part.column(c) for c in ("query_id", "v", "n", "kth"))],
                    ["first", "pieces", "lists", "query_id", "v", "n", "kth"],
                )

    return queries.select("query_id", "v", "n", "kth").mapInArrow(run, f"first bigint, pieces int, lists array<bigint>, query_id {kind}, v array<double>, n double, kth double")


def _meet(index: VectorIndex, calls: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Apply ``work(vectors, queries)`` to each list, or piece of one, with each block of the queries that visit it."""
    calls = materialize(calls)
    length = F.floor(F.col("first") / _PER_LENGTH)
    block = F.greatest(F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK * USUAL) / length)), F.lit(1))
    cuts = materialize(calls.groupBy("first").agg(F.ceil(F.count("*") / F.first(block)).cast("int").alias("blocks")))  # one row a list at most
    visited = calls.select(F.explode("lists").alias("list")).distinct()
    places = [(int(x), int(f), int(p)) for d, lists in index.lists.items() for x, f, p in zip(lists.numbers, *_dealt(d, lists), strict=True)]
    places = materialize(calls.sparkSession.createDataFrame(places, "list bigint, first bigint, pieces int").join(visited, "list").join(cuts, "first"))
    piece, number = F.col("first") + F.pmod(F.xxhash64("id"), F.col("pieces")), F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int")
    own = index.vectors.join(bounded_broadcast(places), "list").select(piece.alias("piece"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "list", "id", "v", "n")
    every = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("pieces") - 1))
    more = [c for c in calls.columns if c not in ("first", "pieces")]
    asked = calls.join(bounded_broadcast(cuts), "first").select(every.alias("piece"), number.alias("block"), *more)

    def lists(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not vectors.num_rows or not queries.num_rows:
            return work(vectors, queries)
        own = vectors.column("list").to_numpy()
        order = np.argsort(own, kind="stable")
        vectors, own = vectors.combine_chunks().take(pa.array(order)), own[order]
        calls = queries.column("lists").combine_chunks()
        asked, rows = calls.flatten().to_numpy(), np.repeat(np.arange(len(calls)), pc.list_value_length(calls).to_numpy())
        order = np.argsort(asked, kind="stable")
        asked, rows, queries = asked[order], rows[order], queries.drop_columns("lists").combine_chunks()
        done = [work(vectors.slice(0, 0), queries)]
        for x, i in zip(*np.unique(own, return_index=True), strict=True):
            some = rows[np.searchsorted(asked, x) : np.searchsorted(asked, x, "right")]
            if len(some):
                done.append(work(vectors.slice(i, np.searchsorted(own, x, "right") - i), queries if len(some) == len(queries) else queries.take(pa.array(some))))
        return pa.concat_tables(done)

    keys = ["piece", "block"]
    return own.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(lists, schema)


def _empty(query_id: T.StructField, article_id: T.StructField, name: str, kind: pa.DataType) -> pa.Table:
    fields = [pa.field("query_id", to_arrow_type(query_id.dataType)), pa.field("id", to_arrow_type(article_id.dataType)), pa.field(name, kind)]
    return pa.schema(fields).empty_table()


def _scores(vectors: pa.Table, queries: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(first query, scores) of some queries at a time with all vectors."""
    own, norms = _matrix(vectors.column("v")), vectors.column("n").to_numpy()
    asked, lengths = _matrix(queries.column("v")), queries.column("n").to_numpy()
    for i in range(0, len(asked), TOGETHER):
        yield i, np.round(asked[i : i + TOGETHER] @ own.T / (lengths[i : i + TOGETHER, None] * norms), 6)


def _best(index: VectorIndex, calls: DataFrame, k: int) -> DataFrame:
    """query_id, id, score: of each piece the best ``k`` at most, none below ``kth``."""
    kinds = index.vectors.schema["id"].dataType.simpleString(), calls.schema["query_id"].dataType.simpleString()
    nothing = _empty(calls.schema["query_id"], index.vectors.schema["id"], "score", pa.float64())

    def work(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not vectors.num_rows or not queries.num_rows:
            return nothing
        ids = vectors.column("id").combine_chunks()
        by_id = np.empty(len(ids), np.int64)  # place of each id in their order
        by_id[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        least = queries.column("kth").to_numpy()
        rows, found, scores = [], [], []
        for first, score in _scores(vectors, queries):
            for j, s in enumerate(score):
                near = np.flatnonzero(s >= least[first + j])
                if len(near) > k:
                    near = near[s[near] >= np.partition(s[near], len(near) - k)[len(near) - k]]
                near = near[np.lexsort((by_id[near], -s[near]))][:k]
                rows.append(np.full(len(near), first + j))
                found.append(near)
                scores.append(s[near])
        flat = [np.concatenate([*x, np.zeros(0, t)]) for x, t in ((rows, np.int64), (found, np.int64), (scores, float))]
        return pa.table({"query_id": queries.column("query_id").take(pa.array(flat[0], pa.int64())), "id": ids.take(pa.array(flat[1], pa.int64())), "score": flat[2]})

    return _meet(index, calls, work, f"query_id {kinds[1]}, id {kinds[0]}, score double")


def search_index(index: VectorIndex, queries: DataFrame, k: int = 10, probes: int | None = None, vector: str = "embedding") -> DataFrame:
    """query_id, rank, article id and score of the ``k`` nearest vectors of each query (query_id, embedding)."""
    asked = materialize(_clean(queries, "query_id", vector, "query_id").withColumn("kth", F.lit(-2.0)))
    first = materialize(top(_best(index, _calls(index, asked, probes or FIRST), k), k, "id"))
    if probes is None:
        reached = first.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("found"))
        reached = reached.select(F.col("query_id").alias("_q"), F.when(F.col("found") == k, F.col("least")).alias("least"))
        again = asked.join(reached, F.col("query_id") == F.col("_q"), "left").withColumn("kth", F.coalesce("least", F.lit(-2.0)))
        more = _best(index, _calls(index, again.select("query_id", "v", "n", "kth"), FIRST, beyond=True), k)
        first = top(first.drop("rank").unionByName(more), k, "id")
    return first.withColumnRenamed("id", index.article_id)


def calibrated_probes(index: VectorIndex, queries: DataFrame, k: int = 10, recall: float = 0.95, sample: int = 256, vector: str = "embedding") -> int:
    """The number of nearest lists that hold the share ``recall`` of the true neighbours, measured on at most ``sample`` queries."""
    asked = materialize(queries.select("query_id", vector).orderBy(F.xxhash64("query_id"), "query_id").limit(sample))
    exact = search_index(index, asked, k, vector=vector).select("query_id", F.col(index.article_id).alias("id"))
    filed = exact.join(index.vectors.select("id", "list"), "id").select("query_id", "list")
    places = _visits(index, _clean(asked, "query_id", vector, "query_id").withColumn("kth", F.lit(-2.0)), 0, all_lists=True)
    found = filed.join(places.select("query_id", "list", "place"), ["query_id", "list"]).groupBy("place").count().orderBy("place").collect()
    total, upto = sum(r["count"] for r in found), 0
    for r in found:  # one row a list at most
        upto += r["count"]
        if upto >= recall * total:
            return r["place"] + 1
    return 1


def vector_topk(vectors: DataFrame, queries: DataFrame, k: int = 10, article_id: str = "article_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, article_id and score (cosine) of the ``k`` nearest vectors per query (query_id, embedding), exactly. A query's own id is not excluded."""
    return search_index(build_index(vectors, article_id, vector), queries, k)


def better_counts(index: VectorIndex, pairs: DataFrame, vector: str = "embedding") -> DataFrame:
    """query_id, id, score and ``better``, the number of vectors that stand before this one, for pairs (query_id, id, embedding of the query).

    Lists that hold nothing as near as the farthest of a query's pairs are not visited. Pairs without a vector to meet are left out.
    """
    kinds = index.vectors.schema["id"].dataType.simpleString(), pairs.schema["query_id"].dataType.simpleString()
    asked = _clean(pairs.select("query_id", vector).dropDuplicates(["query_id"]), "query_id", vector, "query_id")
    q = asked.select("query_id", F.col("v").alias("qv"), F.col("n").alias("qn"))
    dot = F.aggregate(F.zip_with("v", "qv", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    own = materialize(pairs.select("query_id", "id").join(q, "query_id"))  # its size is known, so vectors are not shuffled for a few pairs
    met = index.vectors.join(bounded_broadcast(own), "id").where(F.size("v") == F.size("qv"))
    scored = materialize(met.select("query_id", "id", F.round(dot / (F.col("n") * F.col("qn")), 6).alias("score")))
    marks = scored.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("score", "id"))).alias("marks"), F.min("score").alias("kth"))
    calls = _calls(index, asked.join(marks.select("query_id", "kth"), "query_id"), 0, beyond=True)
    calls = calls.join(marks.select("query_id", "marks"), "query_id")
    nothing = _empty(pairs.schema["query_id"], index.vectors.schema["id"], "n", pa.int64())

    def work(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not vectors.num_rows or not queries.num_rows:
            return nothing
        ids = vectors.column("id").to_pylist()
        out_q, out_id, out_n = [], [], []
        names = queries.column("query_id").to_pylist()
        for first, score in _scores(vectors, queries):
            for j, s in enumerate(score):
                ordered = np.sort(s)
                for mark in queries.column("marks")[first + j].as_py():
                    above = len(s) - int(np.searchsorted(ordered, mark["score"], "right"))
                    same = sum(ids[i] < mark["id"] for i in np.flatnonzero(s == mark["score"]))
                    if above + same:
                        out_q.append(names[first + j])
                        out_id.append(mark["id"])
                        out_n.append(above + same)
        return pa.table({"query_id": pa.array(out_q, queries.schema.field("query_id").type), "id": pa.array(out_id, vectors.schema.field("id").type), "n": pa.array(out_n, pa.int64())})

    counted = _meet(index, calls, work, f"query_id {kinds[1]}, id {kinds[0]}, n bigint").groupBy("query_id", "id").agg(F.sum("n").alias("better"))
    return scored.join(counted, ["query_id", "id"], "left").withColumn("better", F.coalesce("better", F.lit(0)))
