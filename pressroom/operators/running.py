"""Running totals that do not put a whole group into one task.

A plain window sorts each group in a single task, which a hot source breaks. Here every group is
cut into consecutive buckets: buckets are totalled first (with map-side combining), the small
table of bucket totals gets the window, and each bucket then continues from its carry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pressroom.session import materialize

_COMBINE = {"sum": F.sum, "max": F.max}


def balanced_buckets(df: DataFrame, keys: list[str], order: list[str], name: str = "_bucket") -> DataFrame:
    """Number the pieces of a range partitioning by keys and order, for use as the bucket of ``running``.

    Pieces hold about the same number of rows however the keys are distributed: a hot group, or a hot moment
    in it, is cut along the order columns. The numbered rows are written out, since a second sampling could cut
    elsewhere.
    """
    return materialize(df.repartitionByRange(*keys, *order).withColumn(name, F.spark_partition_id()))


def running(
    df: DataFrame,
    keys: list[str],
    bucket: list[str],
    order: list[Column | str],
    totals: dict[str, tuple[str, Column]],
) -> DataFrame:
    """Add running ``sum``/``max`` columns per group, each up to and including the row.

    ``bucket`` columns must sort consistently with ``order`` inside a group: all rows of a lower
    bucket come before all rows of a higher one.
    """
    values = {name: value for name, (_, value) in totals.items()}
    staged = df.withColumns({f"_v_{n}": v for n, v in values.items()})
    per_bucket = staged.groupBy(*keys, *bucket).agg(
        *[_COMBINE[kind](f"_v_{n}").alias(f"_t_{n}") for n, (kind, _) in totals.items()]
    )
    across = W.partitionBy(*keys).orderBy(*bucket).rowsBetween(W.unboundedPreceding, -1)
    carries = per_bucket.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys + bucket],
        *[_COMBINE[kind](f"_t_{n}").over(across).alias(f"_c_{n}") for n, (kind, _) in totals.items()],
    )
    same = None
    for k in keys + bucket:
        test = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        same = test if same is None else same & test
    inside = W.partitionBy(*keys, *bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    joined = staged.join(carries, same, "left")
    out = {}
    for name, (kind, _) in totals.items():
        local = _COMBINE[kind](f"_v_{name}").over(inside)
        carry = F.col(f"_c_{name}")
        out[name] = F.coalesce(carry, F.lit(0)) + local if kind == "sum" else F.greatest(carry, local)
    return joined.withColumns(out).drop(
        *[f"_k_{k}" for k in keys + bucket], *[f"{p}_{n}" for n in totals for p in ("_v", "_c")]
    )


def positions(df: DataFrame, order: list[str], name: str = "_n") -> DataFrame:
    """Number all rows from 1 in an order. Rows are dealt out in ranges and counted range by range; the counts, one a range, are summed up in the
    driver. The dealt rows are written out in between, since another sampling could cut elsewhere."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id())
    dealt = materialize(dealt.withColumns({"_piece": F.shiftright("_row", 33), "_row": F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))}))
    bases, upto = [], 0
    for r in dealt.groupBy("_piece").count().orderBy("_piece").collect():  # one row a range
        bases.append((r["_piece"], upto))
        upto += r["count"]
    base = df.sparkSession.createDataFrame(bases, "_piece bigint, _base bigint")
    return dealt.join(F.broadcast(base), "_piece").withColumn(name, F.col("_base") + F.col("_row") + 1).drop("_piece", "_base", "_row")
