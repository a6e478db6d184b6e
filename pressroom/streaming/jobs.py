"""Landing files in, new URLs and idempotent rows out.

What is new is told by state (``state``), and new rows go to the file sink, which commits a batch once. Every other sink is a ``foreachBatch``
whose effect depends on the batch content and id only. Either way a replayed batch after a lost driver leaves the tables as they were.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from pressroom.functions import urls as U
from pressroom.operators.dedupe import pick_first
from pressroom.operators.reports import SKIPPED
from pressroom.sources.rawdata import _exists, merge_into_storage
from pressroom.streaming.state import first_sightings


def landing_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", str(files_per_trigger)).load(path)


def _without_own_batch(spark: SparkSession, table: str, batch_id: int) -> DataFrame | None:
    """The keys of the table as it was before this batch: a replay must not see its own first try."""
    if not _exists(spark, table):
        return None
    # a stated schema, as batches without new URLs leave no file to read one from
    return spark.read.schema("source_name string, url_hash string, batch_id bigint").parquet(table).filter(F.col("batch_id") != batch_id)


def append_new_urls(batch: DataFrame, batch_id: int, table: str) -> None:
    """Append the URLs of a batch the table does not hold yet; ``batch`` has ``source_name`` and ``url``.

    For a batch now and then: it is compared with the whole table. Streams keep state instead.
    """
    spark = batch.sparkSession
    hashed = batch.withColumn("url_hash", U.short_hash("url"))
    order = [c for c in ("position",) if c in batch.columns] or ["url"]
    fresh = pick_first(hashed, ["source_name", "url_hash"], order)
    seen = _without_own_batch(spark, table, batch_id)
    if seen is not None:
        fresh = fresh.join(seen.select("source_name", "url_hash"), ["source_name", "url_hash"], "left_anti")
    # Overwriting only the batch's own partition makes a replay harmless.
    fresh.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "batch_id").parquet(table)


def stream_discover(landing: DataFrame, discover: Callable[[DataFrame], DataFrame], links: str, checkpoint: str) -> DataStreamWriter:
    """Run a batch discovery on every micro-batch of landing rows; what it finds goes to ``links``, a folder for each batch.

    Discovery compares the rows of a batch with each other, which no streaming query can; so what is new is told by a second stream over
    ``links``, see ``link_stream``.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        discover(batch).write.mode("overwrite").parquet(f"{links.rstrip('/')}/{batch_id}")

    return landing.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode("append")


def link_stream(spark: SparkSession, landing: DataFrame, discover: Callable[[DataFrame], DataFrame], links: str, files_per_trigger: int = 100) -> DataFrame:
    """What ``stream_discover`` finds, as a stream. A replayed batch replaces its files; files that went before they were read are passed over, and the
    rows of their successors are known or new like any others."""
    found = discover(spark.createDataFrame([], landing.schema)).schema
    reader = spark.readStream.schema(found).option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
    return reader.option("maxFilesPerTrigger", str(files_per_trigger)).parquet(links)


def stream_dedupe(
    candidates: DataFrame, table: str, checkpoint: str, order: list[str] | None = None, ttl: timedelta | None = None, known: DataFrame | None = None
) -> DataStreamWriter:
    """Append to ``table`` each URL that its source has not had yet (see ``first_sightings``). The table itself is never read."""
    fresh = first_sightings(candidates, order, ttl, known)
    return fresh.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append")


def dedupe_within(candidates: DataFrame, delay: str = "2 days", time: str = "fetched_at") -> DataFrame:
    """Bounded form: state is kept for the delay only. Rows older than the watermark are dropped, and a repeat
    further than the delay from its first sighting can pass again."""
    return candidates.withColumn("url_hash", U.short_hash("url")).withWatermark(time, delay).dropDuplicatesWithinWatermark(
        ["source_name", "url_hash"])


def stream_upsert_rawdata(records: DataFrame, table: str, staging: str, checkpoint: str) -> DataStreamWriter:
    """Upsert each batch; the staging folder of a batch doubles as its done-marker."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        merge_into_storage(batch.sparkSession, batch, table, f"{staging.rstrip('/')}/{batch_id}")

    return records.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)


def windowed_run_stats(outcomes: DataFrame, window: str = "6 hours", delay: str | None = "1 hour", time: str = "fetched_at",
                       source: str = "source_id") -> DataFrame:
    """Success and failure counts per source and window; works on a stream and on a batch."""
    timed = outcomes.withWatermark(time, delay) if outcomes.isStreaming and delay else outcomes
    return timed.groupBy(F.window(time, window).alias("_w"), source).agg(
        F.count(F.lit(1)).alias("discovered"),
        F.count_if(F.col("status") == SKIPPED).alias("skipped"),
        F.count_if(F.col("status") == "SUCCESS").alias("success"),
        F.count_if(~F.col("status").isin(SKIPPED, "SUCCESS")).alias("failed"),
    ).select(F.col("_w.start").alias("window_start"), source, "discovered", "skipped", "success", "failed")
