"""Stored artifacts: JSON sidecars and gzip HTML objects, and the columnar form of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom.functions import ids
from pressroom.functions.text import blank_to_null, iso_timestamp
from pressroom.functions.urls import content_hash, url_hash_v1
from pressroom.operators.quality import compatible_view, is_blank
from pressroom.sources.objects import read_objects, write_objects


def read_metadata(spark: SparkSession, root: str, folder: str = "crawl_data/metadata") -> DataFrame:
    """JSON sidecars: path, text, parsed fields of both generations, and whether the text is readable JSON.

    Sidecars whose top level is not an object are left out; unreadable ones stay, with null fields.
    """
    files = read_objects(spark, root, folder, ".json", text=True)
    documents = files.select(F.col("key").alias("metadata_path"), "modified_at", F.col("text").alias("json")).withColumn(
        "readable", F.try_parse_json("json").isNotNull())
    objects = documents.filter(~F.col("readable") | F.schema_of_variant(F.try_parse_json("json")).startswith("OBJECT"))
    return compatible_view(objects)


def artifact_keys(metadata: DataFrame) -> DataFrame:
    """Lookup form of sidecars: source folder and URL hash come from the path, as the file name carries both."""
    name = F.substring_index("metadata_path", "/", -1)
    return metadata.select(
        F.regexp_extract("metadata_path", r"metadata/([^/]+)/", 1).alias("source_name"),
        F.regexp_extract(name, r"([0-9a-f]{16})", 1).alias("url_hash"),
        "modified_at", "metadata_path", "readable", "status", "fetched_at",
    )


def read_raw_html(spark: SparkSession, root: str, folder: str = "crawl_data/raw") -> DataFrame:
    """Raw objects with their key, and the hash and size of the decompressed bytes (null if damaged)."""
    files = read_objects(spark, root, folder, ".html.gz")
    return files.select(F.col("key").alias("raw_object_key"), "content_hash", "size_bytes")


def write_raw_html(rows: DataFrame, root: str, html: str = "html") -> None:
    """Write each page that has a ``raw_object_key`` to an object of its own."""
    stored = rows.filter(F.col("raw_object_key").isNotNull())
    write_objects(stored.select(F.col("raw_object_key").alias("key"), F.col(html).alias("body")), root)


def _relative_key(root: str) -> Column:
    prefix = "^.*?" + root.rstrip("/").replace(".", r"\.") + "/"
    return F.url_decode(F.regexp_replace(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")), prefix, ""))


def raw_object_keys(spark: SparkSession, root: str, folder: str = "crawl_data/raw") -> DataFrame:
    """Keys only, from file listings; no object is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.html.gz").load(
        f"{root.rstrip('/')}/{folder}")
    return files.select(_relative_key(root).alias("raw_object_key"))


def artifact_rows(articles: DataFrame, zone: str = "UTC", html: str = "html") -> DataFrame:
    """Metadata of version 2 plus payload and keys for crawled pages, ready to be written.

    Needs ``source_name, url, final_url, fetched_at, status, http_status, crawl_run_id`` and the article
    fields. A blank page gets no object key and no payload hash.
    """
    stored = ~is_blank(html)
    key = ids.raw_object_key("source_name", "url", "fetched_at", zone)
    day = F.from_utc_timestamp("fetched_at", zone)
    return articles.withColumns(
        {
            "schema_version": F.lit(2),
            "source": F.col("source_name"),
            "final_url": F.coalesce(blank_to_null("final_url"), F.col("url")),
            "crawl_id": ids.crawl_id("url", "fetched_at"),
            "url_hash": url_hash_v1("url"),
            "raw_object_key": F.when(stored, key),
            "raw_html_path": F.when(stored, key),
            "metadata_path": ids.metadata_object_key("source_name", "url", "fetched_at", zone),
            "raw_payload_type": F.when(stored, F.lit("text/html")),
            "raw_content_hash": F.when(stored, content_hash(html)),
            "fetched_at_text": iso_timestamp("fetched_at"),
            "yyyy": F.date_format(day, "yyyy"), "mm": F.date_format(day, "MM"), "dd": F.date_format(day, "dd"),
        }
    )


def write_artifacts(rows: DataFrame, path: str, html: str = "html") -> None:
    """Write payloads and metadata as two tables partitioned by source and date.

    HTML is compressed inside the columnar file. Rebalancing gathers a source and day into files of a good size
    and splits the ones that are too large, so a source with a third of all rows does not end in one writer.
    """
    partitions = ["source", "yyyy", "mm", "dd"]
    out = rows.withColumn("source", ids.safe_source_name("source"))
    payloads = out.filter(F.col("raw_object_key").isNotNull()).select(
        *partitions, "raw_object_key", "url_hash", "crawl_id", "raw_content_hash", F.col(html).alias("html"))
    payloads.hint("rebalance", *partitions).write.mode("append").option("compression", "zstd").partitionBy(*partitions).parquet(
        f"{path.rstrip('/')}/raw")
    out.drop(html, "raw_html_path", "source_name").hint("rebalance", *partitions).write.mode("append").partitionBy(*partitions).parquet(
        f"{path.rstrip('/')}/metadata")


def read_metadata_lines(spark: SparkSession, path: str) -> DataFrame:
    """Sidecars compacted to one document per line: the form to keep millions of them in.

    Reads like ``read_metadata``; the path column is left out, as many documents share a file.
    """
    documents = spark.read.text(path).select(F.col("value").alias("json")).withColumn("readable", F.try_parse_json("json").isNotNull())
    objects = documents.filter(~F.col("readable") | F.schema_of_variant(F.try_parse_json("json")).startswith("OBJECT"))
    return compatible_view(objects)



def read_metadata_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", f"{path.rstrip('/')}/metadata").parquet(f"{path.rstrip('/')}/metadata")


def read_raw_table(spark: SparkSession, path: str) -> DataFrame:
    """Objects of the columnar store: key, hash of the stored bytes and size."""
    stored = spark.read.parquet(f"{path.rstrip('/')}/raw")
    return stored.select("raw_object_key", content_hash("html").alias("content_hash"),
                         F.octet_length("html").cast("bigint").alias("size_bytes"))
