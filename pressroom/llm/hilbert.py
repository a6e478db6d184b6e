"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is cut into 2^bits cells at its quantiles over all rows, the cell numbers give a position on the Hilbert curve, and
rows in the order of the curve are cut into runs of equal count. Rows of a shard are then near each other in every
dimension, and a filter on any of them skips most shards by their minimum and maximum (``shard_ranges``).

Text and binary dimensions are cut at whole values, by running counts over their distinct values in order, so values that begin alike get
cells of their own. A null lies in the first cell. Equal cells are ordered by the
tie columns, so repeated rows sit side by side. A hot value is just a long run of the curve and is cut like any other. An empty
table gives no rows. Clashing names (curve, shard, slot) are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressroom.llm.ordering import with_positions
from pressroom.operators.running import balanced_buckets, running


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the curve for rows of ``cells`` (one column a dimension, each below 2^bits)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):  # undo rotations and reflections from coarse to fine
        low = (1 << level) - 1
        for i in range(n):
            flip = (x[i] >> level & 1).astype(bool)
            swapped = (x[0] ^ x[i]) & low
            x[0] ^= np.where(flip, low, swapped)
            x[i] ^= np.where(flip, 0, swapped)
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[n - 1] >> level & 1, (1 << level) - 1, 0)
    x ^= turn
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            index = index << 1 | (x[i] >> level & 1)
    return index


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.StringType, T.BinaryType))


def _number(df: DataFrame, name: str) -> Column:
    """The dimension as a number in the same order."""
    if isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("timestamp").cast("double")
    return F.col(name).cast("double")


def _text_cuts(df: DataFrame, name: str, cells: int) -> list[bytes]:
    """The values at which the quantiles of a text lie, at most one a cell, from counts of all distinct values."""
    distinct = df.where(F.col(name).isNotNull()).groupBy(F.col(name).cast("binary").alias("value")).agg(F.count("*").alias("n"))
    total = F.sum("n").alias("total")
    counted = running(balanced_buckets(distinct, [], ["value"]), [], ["_bucket"], ["value"], {"upto": ("sum", F.col("n"))})
    # a value is a cut where the rows up to it reach another part of the whole
    part = lambda rows: F.ceil(rows * cells / F.col("total"))
    cuts = counted.crossJoin(F.broadcast(distinct.agg(total))).where(part(F.col("upto")) > part(F.col("upto") - F.col("n")))  # one row of totals
    return sorted(bytes(r["value"]) for r in cuts.select("value").collect())  # at most ``cells`` rows


def quantise(df: DataFrame, dimensions: Sequence[str], bits: int) -> list[Column]:
    """Cell numbers of each dimension, cut at quantiles over all rows; at most 2^bits cuts each go through the driver."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = [d for d in dimensions if not _is_text(df, d)]
    found = df.agg(F.lit(0), *[F.percentile_approx(_number(df, d), shares, 10_000).alias(d) for d in numbers]).first()

    def cell(d: str) -> Column:
        if _is_text(df, d):
            x, kind, cuts = F.col(d).cast("binary"), "array<binary>", [F.lit(c) for c in _text_cuts(df, d, 1 << bits)[1:]]
        else:
            x, kind, cuts = _number(df, d), "array<double>", [F.lit(float(c)) for c in sorted(set(found[d] or []))]
        return F.when(x.isNull(), 0).otherwise(F.size(F.filter(F.array(*cuts).cast(kind), lambda c: c <= x))).cast("int")

    return [cell(d) for d in dimensions]


def hilbert_shards(
    df: DataFrame, dimensions: Sequence[str], shards: int, bits: int = 6, ties: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """All rows with ``curve``, ``shard`` (0 up to ``shards``, counts at most one apart) and ``slot`` (from 0 without gaps)."""

    @F.pandas_udf(T.LongType())
    def index(*cells: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([c.to_numpy() for c in cells], 1), bits))

    df = df.drop("curve", "shard", "slot")
    keyed = df.withColumn("curve", index(*quantise(df, dimensions, bits))).withColumn("_tie", F.xxhash64(*df.columns))
    placed = with_positions(keyed, ["curve", *ties, "_tie"], "_position", "_total").drop("_tie")
    shard = F.expr(f"_position * {shards} div _total")
    first = F.expr(f"(shard * _total + {shards - 1}) div {shards}")
    return (
        placed.withColumn("shard", shard).withColumn("slot", F.col("_position") - first)
        .withColumn("shard", F.col("shard").cast("int")).drop("_position", "_total")
    )


def shard_ranges(sharded: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Rows, and minimum and maximum of each dimension, by shard: what a reader needs to skip shards."""
    ends = [f(d).alias(f"{n}_{d}") for d in dimensions for f, n in ((F.min, "min"), (F.max, "max"))]
    return sharded.groupBy("shard").agg(F.count("*").alias("n_rows"), *ends)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, rows in the order of their slots, statistics in the Parquet footers."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
