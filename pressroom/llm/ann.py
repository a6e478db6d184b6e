"""Nearest neighbours by inner product with multi-index hashing.

Vectors become binary codes: the signs after rotations learned (iterative quantisation) on a bounded sample. For inner products of
vectors of unequal length a coordinate is added that makes all lengths equal, so that angles order as products do. Codes are cut
into bytes, and each block of rows is indexed by every byte. By the pigeonhole principle a code within Hamming radius R of the
query's is, in some byte, within R // bytes bits (the first R % bytes + 1 of them) or one less (the rest): probing the postings
of those byte values retrieves every code within R. What they give is checked on the whole code and then ranked by the exact inner
product in double precision.

Each query's radius is read off the sample: the distance that holds ``candidates`` rows of the whole table in expectation. A query that
still finds fewer rows than asked for is searched again with every row in its radius.

The query set is taken in blocks against all rows in blocks; no row of the index is left out. Null or zero vectors, those with a null
or non-finite component, and those of another length than most take no part. Of identical vectors only the ``k`` + 1 smallest ids can be
among k nearest, so others are dropped from the index (not from the queries) beforehand, by a rank that Spark cuts in each map task.
Rows with a null vec_id take no part. Repeated rows (same id and vector) count once. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pressroom.session import bounded_broadcast, materialize

#: Radii are read off at most so many rows, those with the smallest hash of their id; rotations are fitted on the first of them.
#: The index has every row.
SAMPLE, FIT = 16_384, 8192
BITS = 256
ROWS, QUERIES = 8192, 1024
_NEAR = [np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)) <= r for r in range(9)]


def clean(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v): rows that take part, v as array<double>."""
    v = F.transform(vector, lambda x: x.cast("double"))
    kept = vectors.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    )
    usual = kept.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(1)
    return kept.join(F.broadcast(usual.select("size")), F.size("v") == F.col("size"), "left_semi")  # one row


def augmented(x: np.ndarray, longest: float) -> np.ndarray:
    """Rows scaled into the unit ball, with the coordinate that puts them on the sphere."""
    x = x / longest
    return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1, keepdims=True)))])


def learn_rotations(x: np.ndarray, bits: int, seed: int = 1, rounds: int = 8) -> np.ndarray:
    """Matrix to ``bits`` signs: blocks of rotations, each turned until the rows lie near corners of the cube."""
    rng, size = np.random.default_rng(seed), x.shape[1]
    blocks = []
    for _ in range(-(-bits // size)):
        turn = np.linalg.qr(rng.normal(size=(size, size)))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.sign(x @ turn).T @ x)
            turn = (u @ v).T
        blocks.append(turn)
    return np.hstack(blocks)[:, :bits]


def encode(x: np.ndarray, turn: np.ndarray) -> np.ndarray:
    return np.packbits(x @ turn > 0, axis=1)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)).sum(axis=-1, dtype=np.int64)


def within_radius(code: np.ndarray, radius: int, codes: np.ndarray, postings: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Rows of ``codes`` within ``radius`` of ``code``, found by probing the postings of each byte."""
    chunks = codes.shape[1]
    base, rest = divmod(min(radius, 8 * chunks), chunks)
    found = np.zeros(len(codes), bool)
    for j, (order, counts) in enumerate(postings):
        allowed = base if j <= rest else base - 1
        if allowed >= 0:
            found[order[np.repeat(_NEAR[min(allowed, 8)][code[j]], counts)]] = True
    rows = np.flatnonzero(found)
    return rows[hamming(codes[rows], code[None]) <= radius]


def _blocks(df: DataFrame, n_blocks: int, name: str, schema: str, make: Callable[[np.ndarray, np.ndarray], list]) -> DataFrame:
    """Rows dealt to blocks of bounded size by their id; ``make`` turns ids and vectors of a block into its columns."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        x = table.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        at = np.argsort(ids)
        values = make(ids[at], x[at])
        return pa.table({n: [v] for n, v in zip([name, *[c.split()[0] for c in schema.split(", ")]], [table.column(name)[0].as_py(), *values], strict=True)}, target)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(f"{name} int, {schema}"))
    block = F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int")
    return df.withColumn(name, block).groupBy(name).applyInArrow(run, f"{name} int, {schema}")


def nearest(
    vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector: str = "embedding", candidates: int = 1500
) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest rows found for every row that ``is_query`` holds for, itself excluded.

    Nearness is the largest inner product, ties go to the smaller id; fewer rows come back only where fewer exist.
    """
    marked = vectors.where(is_query).select(F.col(id_col).cast("bigint").alias("id")).distinct()
    rows = clean(vectors, id_col, vector).dropDuplicates(["id"])
    alike = W.partitionBy("v").orderBy("id")
    indexed = materialize(rows.withColumn("_rank", F.row_number().over(alike)).where(F.col("_rank") <= k + 1).drop("_rank"))
    # identical queries are searched once, under the smallest of their ids
    asked = materialize(rows.join(bounded_broadcast(marked), "id", "left_semi"))
    queries = asked.groupBy("v").agg(F.min("id").alias("id"))
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    n_rows, longest = indexed.agg(F.count("*"), F.max(norm)).first()
    n_queries = queries.count()
    if not n_rows or not n_queries:
        return vectors.sparkSession.createDataFrame([], schema)

    sample = indexed.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toPandas()
    fitted = augmented(np.stack(sample["v"].to_numpy()), longest)
    turn = learn_rotations(fitted[:FIT], BITS)
    known = encode(fitted, turn)
    nth = min(len(known), max(16, -(-candidates * len(known) // n_rows)))  # that many of the sample stand for ``candidates`` rows

    def of_rows(ids, x):
        return [ids.astype("<i8").tobytes(), x.astype("<f8").tobytes(), encode(augmented(x, longest), turn).tobytes()]

    def of_queries(ids, x):
        unit = x / np.sqrt((x * x).sum(1, keepdims=True))
        codes = encode(np.hstack([unit, np.zeros((len(x), 1))]), turn)
        radius = [int(np.partition(hamming(known, c[None]), nth - 1)[nth - 1]) for c in codes]
        return [ids.astype("<i8").tobytes(), x.astype("<f8").tobytes(), codes.tobytes(), np.array(radius, "<i8").tobytes()]

    n_blocks, q_blocks = -(-n_rows // ROWS), -(-n_queries // QUERIES)
    index = materialize(_blocks(indexed, n_blocks, "block", "ids binary, x binary, codes binary", of_rows))
    asking = "q_ids binary, q_x binary, q_codes binary, radius binary"
    asks = materialize(_blocks(queries, q_blocks, "q_block", asking, of_queries))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, q_ids, radius = (np.frombuffer(row[c], "<i8") for c in ("ids", "q_ids", "radius"))
                x, q_x = (np.frombuffer(row[c], "<f8").reshape(len(i), -1) for c, i in (("x", ids), ("q_x", q_ids)))
                codes, q_codes = (np.frombuffer(row[c], np.uint8).reshape(len(i), -1) for c, i in (("codes", ids), ("q_codes", q_ids)))
                postings = [(np.argsort(c, kind="stable"), np.bincount(c, minlength=256)) for c in codes.T]
                out = []
                for i in range(len(q_ids)):
                    near = within_radius(q_codes[i], radius[i], codes, postings)
                    score = (x[near] * q_x[i]).sum(axis=1)
                    best = np.lexsort((ids[near], -score))[: k + 1]
                    out.append((np.full(len(best), q_ids[i]), ids[near[best]], score[best]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["q", "vec_id", "score"])

    def searched(asks: DataFrame) -> DataFrame:
        pairs = asks.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).join(index, "block")
        return pairs.repartition("block", "q_block").mapInArrow(search, "q bigint, vec_id bigint, score double")

    def of_short(ids, x):
        return [*of_queries(ids, x)[:3], np.full(len(ids), BITS, "<i8").tobytes()]

    found = materialize(searched(asks))
    counts = found.groupBy(F.col("q").alias("id")).agg(F.count("*").alias("n"))
    short = queries.select("id").join(counts, "id", "left").where(F.coalesce("n", F.lit(0)) < min(k + 1, n_rows)).select("id")
    short = materialize(short)
    if not short.isEmpty():
        again = searched(_blocks(queries.join(short, "id"), q_blocks, "q_block", asking, of_short))
        found = found.join(short.select(F.col("id").alias("q")), "q", "left_anti").unionByName(again)

    # back to every query of the class, without itself
    classes = queries.select(F.col("id").alias("q"), "v")
    every = asked.select(F.col("id").alias("query_id"), "v").join(classes, "v").select("query_id", "q")
    best = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    first = found.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1).drop("_r")
    own = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = every.join(first, "q").where("query_id != vec_id").withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
