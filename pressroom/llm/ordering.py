"""Gapless positions over a whole table in a given order, without one task that sees every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pressroom.session import materialize


def with_positions(df: DataFrame, order: list[str], name: str = "position", total: str | None = None) -> DataFrame:
    """Add ``name``, counting rows from 0 in the order of the columns, and ``total``, the number of rows.

    Rows are dealt out in ranges and sorted; each range is counted, and the counts, one row a range, are summed up. The dealt
    rows are written out in between, since another sampling could cut elsewhere.
    """
    row = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id())
    dealt = materialize(dealt.withColumns({"_piece": F.shiftright("_row", 33), "_row": row}))
    counts = dealt.groupBy("_piece").agg(F.count("*").alias("_n"))
    before = W.orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy("_piece").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    bases = counts.select("_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"), F.sum("_n").over(everything).alias("_all"))
    out = dealt.join(F.broadcast(bases), "_piece")  # one row a partition
    added = {name: F.col("_base") + F.col("_row")} | ({total: F.col("_all")} if total else {})
    return out.withColumns(added).drop("_piece", "_row", "_base", "_all")
