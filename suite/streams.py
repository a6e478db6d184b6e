"""Streaming jobs over the driver tables landed as files."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressroom.functions import urls as U
from pressroom.operators import discover
from pressroom.schemas import RAWDATA
from pressroom.session import plan_bytes
from pressroom.sources import rawdata
from pressroom.streaming import jobs
from suite import query
from suite.discovery import _LISTED, _listing_sources, _listings
from suite.lookups import _rawdata
from suite.storage import work_dir
from suite.views import LOG, crawl_log, pages

LOG_SCHEMA = "id bigint, source_id bigint, url string, status string, fetched_at timestamp"


def _run(writer) -> None:
    """Process everything that has landed, then stop."""
    writer.trigger(availableNow=True).start().awaitTermination()


def _landed_log(spark, sf_dir, folder: str, schema: str, rows) -> str:
    """The log as landing files, a few per six hours of crawling."""
    path = f"{folder}/landing"
    rows.repartitionByRange(8, "fetched_at").write.parquet(path)
    return path


def _landing_files(size: int) -> tuple[int, int]:
    """Files of some 16 MB as stored for a landing of ``size`` bytes, and how many make a batch: enough to keep a cluster busy, and bounded."""
    files = max(4, size >> 24)
    return files, min(files // 2, 48)


@query("r1_stream_discover", f"with {_LISTED} select source_name, url from u")
def stream_discover(spark, sf_dir):
    """Listing pages arrive in files; each batch adds the article URLs that are new."""
    folder = work_dir(spark)
    listings = _listings(spark, sf_dir)
    files, at_once = _landing_files(plan_bytes(pages(spark, sf_dir)))
    listings.repartitionByRange(files, "listing_pos").write.parquet(f"{folder}/landing")
    sources = _listing_sources(spark)
    landing = jobs.landing_stream(spark, f"{folder}/landing", listings.schema.simpleString()[7:-1].replace(":", " "), files_per_trigger=at_once)
    find = lambda batch: discover.discover_listing(batch, sources)
    _run(jobs.stream_discover(landing, find, f"{folder}/links", f"{folder}/checkpoint"))
    links = jobs.link_stream(spark, landing, find, f"{folder}/links", files_per_trigger=8)
    _run(jobs.stream_dedupe(links, f"{folder}/urls", f"{folder}/checkpoint-links"))
    return spark.read.schema("source_name string, url string").parquet(f"{folder}/urls")


@query("r2_stream_dedupe", f"with {LOG} select concat('s', source_id) as source_name, url, substr(sha256(url), 1, 16) as url_hash from log group by source_id, url")
def stream_dedupe(spark, sf_dir):
    folder = work_dir(spark)
    path = _landed_log(spark, sf_dir, folder, LOG_SCHEMA, crawl_log(spark, sf_dir).select("id", "source_id", "url", "status", "fetched_at"))
    seen = jobs.landing_stream(spark, path, LOG_SCHEMA, files_per_trigger=3)
    candidates = seen.select(F.concat(F.lit("s"), "source_id").alias("source_name"), U.normalize_v1("url").alias("url"))
    _run(jobs.stream_dedupe(candidates, f"{folder}/urls", f"{folder}/checkpoint"))
    return spark.read.schema("source_name string, url string, url_hash string").parquet(f"{folder}/urls")


@query("r2_stream_dedupe_bounded", f"with {LOG} select concat('s', source_id) as source_name, url from log group by source_id, url")
def stream_dedupe_bounded(spark, sf_dir):
    """State kept for longer than the data spans, so every repeat is caught."""
    folder = work_dir(spark)
    path = _landed_log(spark, sf_dir, folder, LOG_SCHEMA, crawl_log(spark, sf_dir).select("id", "source_id", "url", "status", "fetched_at"))
    seen = jobs.landing_stream(spark, path, LOG_SCHEMA, files_per_trigger=3)
    candidates = seen.select(F.concat(F.lit("s"), "source_id").alias("source_name"), "url", "fetched_at")
    unique = jobs.dedupe_within(candidates, "60 days").select("source_name", "url")
    _run(unique.writeStream.format("parquet").option("path", f"{folder}/urls").option("checkpointLocation", f"{folder}/checkpoint"))
    return spark.read.schema("source_name string, url string").parquet(f"{folder}/urls")


@query("r3_stream_upsert_rawdata", f"""with {LOG} select source_id, crawl_run_id, url, arg_max(status, (fetched_at, id)) as status, count(*) > 0 as has_id from log group by 1, 2, 3""")
def stream_upsert(spark, sf_dir):
    folder = work_dir(spark)
    rows = _rawdata(crawl_log(spark, sf_dir)).withColumn("id", F.lit(None).cast("bigint"))
    path = _landed_log(spark, sf_dir, folder, RAWDATA, rows)
    records = jobs.landing_stream(spark, path, RAWDATA, files_per_trigger=4)
    _run(jobs.stream_upsert_rawdata(records, f"{folder}/table", f"{folder}/stage", f"{folder}/checkpoint"))
    stored = rawdata.read_rawdata(spark, f"{folder}/table")
    return stored.select("source_id", "crawl_run_id", "url", "status", F.col("id").isNotNull().alias("has_id"))


_WINDOWED = f"""with {LOG} select strftime(time_bucket(interval 6 hour, fetched_at), '%Y-%m-%d %H:%M:%S') as window_start, source_id, count(*) as discovered, cast(0 as bigint) as skipped,
  count(*) filter (status = 'SUCCESS') as success, count(*) filter (status <> 'SUCCESS') as failed from log group by 1, 2"""


def _named_windows(df):
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query("r4_stream_run_stats", _WINDOWED)
def stream_run_stats(spark, sf_dir):
    """Complete-mode counts, written as a table on every batch."""
    folder = work_dir(spark)
    path = _landed_log(spark, sf_dir, folder, LOG_SCHEMA, crawl_log(spark, sf_dir).select("id", "source_id", "url", "status", "fetched_at"))
    seen = jobs.landing_stream(spark, path, LOG_SCHEMA, files_per_trigger=3)
    stats = jobs.windowed_run_stats(seen, delay=None)

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{folder}/stats/{batch_id % 2}")
        batch.sparkSession.range(1).select(F.lit(batch_id % 2).alias("slot")).write.mode("overwrite").parquet(f"{folder}/current")

    _run(stats.writeStream.outputMode("complete").foreachBatch(sink).option("checkpointLocation", f"{folder}/checkpoint"))
    slot = spark.read.parquet(f"{folder}/current").first()["slot"]
    return _named_windows(spark.read.parquet(f"{folder}/stats/{slot}"))


@query("r4_batch_run_stats", _WINDOWED)
def batch_run_stats(spark, sf_dir):
    """The same operator on a batch."""
    return _named_windows(jobs.windowed_run_stats(crawl_log(spark, sf_dir)))
