"""Tables shared by the queries, and the same tables as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def crawl_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch attempts, standing for ``rawdata``: several rows per (source, run, url)."""
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    return e.select(
        F.col("event_id").alias("id"),
        (F.col("user_id") % 5 + 1).cast("bigint").alias("source_id"),
        F.concat(F.lit("https://example.com/a/"), F.col("user_id").cast("string"), F.lit(".html")).alias("url"),
        F.concat(F.lit("run-"), F.dayofmonth("ts").cast("string")).alias("crawl_run_id"),
        F.when(kind == "error", "TIMEOUT").when(kind == "signup", "EMPTY_HTML").when(kind == "view", "CONTENT_NOT_FOUND")
        .otherwise("SUCCESS").alias("status"),
        F.when(kind == "error", 503).when(kind == "signup", 429).otherwise(200).cast("bigint").alias("http_status"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
        F.col("value"),
        F.col("props"),
    )


LOG = """log as (
  select event_id as id, user_id % 5 + 1 as source_id,
         concat('https://example.com/a/', cast(user_id as varchar), '.html') as url,
         concat('run-', cast(day(ts) as varchar)) as crawl_run_id,
         case event_type when 'error' then 'TIMEOUT' when 'signup' then 'EMPTY_HTML'
                         when 'view' then 'CONTENT_NOT_FOUND' else 'SUCCESS' end as status,
         case event_type when 'error' then 503 when 'signup' then 429 else 200 end as http_status,
         ts as fetched_at, value, props
  from events)"""

# Page URLs of the test tables carry at most one of: a tracking parameter, two kept parameters, a fragment.
PAGE_V1 = "regexp_replace(regexp_replace(url, '#.*$', ''), '\\?utm_source=feed$', '')"
PAGE_BASE = "regexp_replace(url, '[?#].*$', '')"
PAGE_HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"
BLANKS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


def clean_sql(x: str) -> str:
    return f"nullif(trim(regexp_replace({x}, '{BLANKS}', ' ', 'g')), '')"


def page_base():
    return F.regexp_replace("url", r"[?#].*$", "")


def stamp(c: str):
    """Timestamps leave the queries as text, so both engines print the same."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)


def stamp_sql(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') as {c}"
