"""Mixing sources to target weights by Poisson replication.

Each source gets a mean number of copies per document, so that the mix meets the target weights: rate = weight * total size /
size of the source, where sizes are counted over all documents. The number of copies of a document is the Poisson quantile at a
point in [0, 1) drawn from a hash of the seed and the document's id, so it does not depend on partitioning, retries or other
documents. A rate over 500 is split into equal parts, each with a hashed point of its own, whose counts are added up. Copies are then put in an order by a second hash, over the whole output.

A null source is a source of its own (weight under None). A document without doc_id is drawn by the hash of an empty id. Repeated
rows are drawn alike. A source with weight 0, or not named in explicit weights, has rate 0. An empty table gives an empty mix.
Names that clash with the added columns (copy, position) are replaced by them. Rates of any size are drawn, from equal shares or given weights.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.llm.ordering import with_positions
from pressroom.session import bounded_broadcast, materialize

#: 13 hex digits: 52 bits, exact in a double.
HEX, STEPS = 13, float(1 << 52)
#: A larger rate is drawn as a sum of equal parts of at most this rate each, which is Poisson again. Copies are made in blocks of as many.
PART = 500


def unit_hash(seed: str, *parts: Column) -> Column:
    """A point in [0, 1) from an md5 over seed and parts, the same on every engine."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HEX), 16, 10).cast("double") / F.lit(STEPS)


def poisson_steps(rate: Column) -> Column:
    """Cumulative Poisson probabilities P(0), P(0..1), ... up to where they stop growing in double precision.

    The rate is one of a part, at most PART, where exp(-rate) is still far from the smallest double.
    """
    rate = rate.cast("double")
    count = F.greatest(F.lit(20), F.ceil(rate + 12 * F.sqrt(rate) + 12)).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("steps"))

    def step(state, k):
        p = state["p"] * rate / k
        total = state["sum"] + p
        return F.struct(p.alias("p"), total.alias("sum"), F.array_append(state["steps"], total).alias("steps"))

    return F.aggregate(F.sequence(F.lit(1), count), start, step, lambda state: state["steps"])


def source_rates(docs: DataFrame, by: str = "source", size: Column | None = None, weights: Mapping[str | None, float] | None = None) -> DataFrame:
    """source, n_docs, size, weight and rate (mean copies) of every source.

    ``size`` is what the weights are shares of, by default rows. Without ``weights`` every source that occurs gets an equal share.
    """
    size = F.lit(1) if size is None else size
    sizes = docs.groupBy(F.col(by).alias("source")).agg(F.count("*").alias("n_docs"), F.sum(F.coalesce(size, F.lit(0))).cast("bigint").alias("size"))
    if weights is None:
        given = sizes.withColumn("given", F.lit(1.0))
    else:
        table = docs.sparkSession.createDataFrame(list(weights.items()) or [(None, 0.0)], "name string, given double")
        given = sizes.join(F.broadcast(table), F.col("name").eqNullSafe(F.col("source")), "left").drop("name").fillna(0.0, ["given"])
    sums = given.agg(F.sum("given").alias("_weights"), F.sum("size").alias("_size"))
    weight = F.when(F.col("_weights") > 0, F.col("given") / F.col("_weights")).otherwise(0.0)
    rate = F.when(F.col("size") > 0, weight * F.col("_size") / F.col("size")).otherwise(0.0)
    return given.crossJoin(F.broadcast(sums)).select("source", "n_docs", "size", weight.alias("weight"), rate.alias("rate"))  # one row of sums


def _draw(seed: str) -> Column:
    """Copies of a row with _steps and _parts: the count of the first part is drawn at the point of the id, others at points of id and part."""
    doc_id = F.col("doc_id")

    def count(u: Column) -> Column:
        return F.size(F.filter("_steps", lambda c: c <= u))

    others = F.sequence(F.lit(2).cast("bigint"), F.col("_parts"))
    more = F.aggregate(others, F.lit(0).cast("bigint"), lambda n, part: n + count(unit_hash(f"{seed}-part", doc_id, part)))
    return count(unit_hash(seed, doc_id)) + F.when(F.col("_parts") > 1, more).otherwise(0)


def replicate(docs: DataFrame, rates: DataFrame, seed: str = "mix", by: str = "source", copy: str = "copy") -> DataFrame:
    """Every document as often as its draw says, numbered from 1 in the column named by ``copy``.

    Documents with rates of several parts are dealt to tasks in blocks of copies, so that no task makes all copies of one.
    """
    parts = F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("rate") / PART))
    steps = materialize(rates.select(F.col("source").alias("_source"), poisson_steps(F.col("rate") / parts).alias("_steps"), parts.alias("_parts")))
    rare = steps.where("_parts > 1")

    def drawn(steps: DataFrame, draw: Column) -> DataFrame:
        rows = docs.drop(copy).join(bounded_broadcast(steps), F.col(by).eqNullSafe(F.col("_source")))
        return rows.withColumn("_copies", draw).where("_copies > 0").drop("_source", "_steps", "_parts")

    usual = drawn(steps.where("_parts = 1"), F.size(F.filter("_steps", lambda c: c <= unit_hash(seed, F.col("doc_id")))))
    usual = usual.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies")
    if rare.isEmpty():
        return usual
    blocks = drawn(rare, _draw(seed)).withColumn("_from", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"), F.lit(PART).cast("bigint"))))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given, so that few blocks are not put together again
    blocks = blocks.repartition(tasks, "doc_id", by, "_from")
    block = F.sequence(F.col("_from"), F.least(F.col("_copies"), F.col("_from") + (PART - 1)))
    copies = blocks.withColumn(copy, F.explode(block)).drop("_copies", "_from")
    return usual.unionByName(copies.withColumn(copy, F.col(copy).cast("int")))


_ORDER = ["_at", "doc_id", "_tie"]


def _keyed(copies: DataFrame, seed: str, copy: str) -> DataFrame:
    at = unit_hash(f"{seed}-order", F.col("doc_id"), F.col(copy))
    return copies.withColumns({"_at": at, "_tie": F.xxhash64(copy, *[c for c in copies.columns if c != copy])})


def shuffled(copies: DataFrame, seed: str = "mix", copy: str = "copy") -> DataFrame:
    """The rows dealt to partitions and sorted in a random order over the whole table, that of a hash, ready to be written."""
    return _keyed(copies, seed, copy).repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).drop("_at", "_tie")


def numbered(copies: DataFrame, seed: str = "mix") -> DataFrame:
    """The rows of ``shuffled`` with their place in that order, ``position`` from 0 without gaps."""
    return with_positions(_keyed(copies.drop("position"), seed, "copy"), _ORDER).drop("_at", "_tie")


def mix(docs: DataFrame, by: str = "source", size: Column | None = None, weights: Mapping[str | None, float] | None = None, seed: str = "mix") -> DataFrame:
    """Documents mixed to the target weights and shuffled: their columns, ``copy`` and ``position``."""
    return numbered(replicate(docs, source_rates(docs, by, size, weights), seed, by), seed)
