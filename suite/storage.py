"""Sources, landing and artifact tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pressroom.functions import urls as U
from pressroom.plans.jobs import crawl_articles
from pressroom.schemas import RAWDATA_COLUMNS
from pressroom.session import ensure_checkpoint_dir
from pressroom.sources import artifacts, config, objects, rawdata
from suite import query
from suite.articles import H1, _metadata_documents
from suite.lookups import _rawdata
from suite.views import LOG, PAGE_V1, crawl_log, pages, table


def work_dir(spark) -> str:
    """A new folder in the shared checkpoint area."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/suite-{uuid.uuid4().hex}"


_SIDECARS = """select case when event_id % 8 in (1, 5, 7) then null else concat('https://e.com/', event_id) end as url, event_id % 8 <> 7 as readable,
  cast(case event_id % 8 when 1 then 1 when 5 then null when 7 then null else 2 end as integer) as schema_version from events"""


@query("s1_read_metadata", _SIDECARS)
def read_metadata(spark, sf_dir):
    """Sidecars written by the tasks, a file each, then listed, read and checked."""
    folder = work_dir(spark)
    documents = _metadata_documents(spark, sf_dir)
    key = F.concat(F.lit("crawl_data/metadata/site/"), F.pmod("event_id", F.lit(20)), F.lit("/"), "event_id", F.lit(".json"))
    objects.write_objects(documents.select(key.alias("key"), F.col("json").alias("body")), folder)
    return artifacts.read_metadata(spark, folder).select("url", "readable", "schema_version")


@query("s1_read_metadata_lines", _SIDECARS)
def read_metadata_lines(spark, sf_dir):
    """Sidecars written out as one document per line, then read and checked like single files."""
    folder = work_dir(spark)
    _metadata_documents(spark, sf_dir).select("json").write.text(folder)
    return artifacts.read_metadata_lines(spark, folder).select("url", "readable", "schema_version")


def _crawled(spark, sf_dir):
    """Pages as crawled articles at one-minute intervals; every tenth came back blank."""
    i = F.col("page_id")
    p = pages(spark, sf_dir).withColumns({
        "html": F.when(i % 10 == 0, " ").otherwise(F.col("html")), "fetched_at": F.timestamp_seconds(F.lit(1704067200) + i * 60),
        "source_name": F.concat(F.lit("site "), i % 3)})
    return p.withColumns({"url": U.normalize_v1("url"), "final_url": F.lit(""), "status": F.when(i % 10 == 0, "EMPTY_HTML").otherwise("SUCCESS"),
                          "crawl_run_id": F.lit("run"), "http_status": F.lit(200)})


_KEYS = f"""k as (select page_id, html, {PAGE_V1} as u, timestamp '2024-01-01 00:00:00' + to_minutes(page_id) as seen from pages),
  a as (select page_id, html, u, concat('site_', page_id % 3) as source, seen, concat(strftime(seen + interval 7 hour, '%Y/%m/%d'), '/', substr(sha256(u), 1, 16), '_', strftime(seen, '%H%M%S_%f')) as name from k)"""


_RAW = f"""with {_KEYS} select concat('crawl_data/raw/', source, '/', name, '.html.gz') as raw_object_key, sha256(html) as content_hash,
  cast(strlen(html) as bigint) as size_bytes from a where page_id % 10 <> 0"""


@query("s2_read_raw_html", _RAW)
def read_raw_html(spark, sf_dir):
    """Pages written by the tasks as gzip objects, then listed, decompressed and hashed."""
    folder = work_dir(spark)
    artifacts.write_raw_html(artifacts.artifact_rows(_crawled(spark, sf_dir), "Asia/Ho_Chi_Minh"), folder)
    return artifacts.read_raw_html(spark, folder)


@query("s2_read_raw_html_of_a_day", f"""with {_KEYS} select concat('crawl_data/raw/', source, '/', name, '.html.gz') as raw_object_key, sha256(html) as content_hash
  from a where page_id % 10 <> 0 and source = 'site_1' and name like '2024/01/01/%'""")
def read_raw_html_of_a_day(spark, sf_dir):
    """Objects of one source and day: the beginning of the key chooses the folder, no other is listed."""
    folder = work_dir(spark)
    artifacts.write_raw_html(artifacts.artifact_rows(_crawled(spark, sf_dir), "Asia/Ho_Chi_Minh"), folder)
    return artifacts.read_raw_html(spark, folder).where(F.startswith("raw_object_key", F.lit("crawl_data/raw/site_1/2024/01/01/"))).select("raw_object_key", "content_hash")


@query("s2_read_raw_table", _RAW)
def read_raw_table(spark, sf_dir):
    """The same from the columnar store."""
    folder = work_dir(spark)
    artifacts.write_artifacts(artifacts.artifact_rows(_crawled(spark, sf_dir), "Asia/Ho_Chi_Minh"), folder)
    return artifacts.read_raw_table(spark, folder)


@query("s3_write_artifacts", f"""with {_KEYS} select page_id, source, strftime(seen + interval 7 hour, '%d') as dd, u as final_url,
  case when page_id % 10 <> 0 then concat('crawl_data/raw/', source, '/', name, '.html.gz') end as raw_object_key,
  concat('crawl_data/metadata/', source, '/', name, '.json') as metadata_path, case when page_id % 10 <> 0 then sha256(html) end as raw_content_hash,
  case when page_id % 10 <> 0 then 'text/html' end as raw_payload_type from a""")
def write_artifacts(spark, sf_dir):
    folder = work_dir(spark)
    artifacts.write_artifacts(artifacts.artifact_rows(_crawled(spark, sf_dir), "Asia/Ho_Chi_Minh"), folder)
    stored = artifacts.read_metadata_table(spark, folder)
    return stored.select("page_id", F.col("source").cast("string").alias("source"), F.lpad(F.col("dd").cast("string"), 2, "0").alias("dd"), "final_url",
                         "raw_object_key", "metadata_path", "raw_content_hash", "raw_payload_type")


@query("s4_read_rawdata", f"""with {LOG} select id, source_id, url, cast(null as varchar) as raw_object_key, cast(null as varchar) as raw_content_hash, status,
  case when id % 4 = 0 then null else crawl_run_id end as crawl_run_id from log""")
def read_rawdata(spark, sf_dir):
    folder = work_dir(spark)
    rows = _rawdata(crawl_log(spark, sf_dir)).withColumn("crawl_run_id", F.when(F.col("id") % 4 == 0, "").otherwise(F.col("crawl_run_id")))
    rows.select(*RAWDATA_COLUMNS).write.parquet(folder)
    return rawdata.reconcile_columns(rawdata.read_rawdata(spark, folder))


@query("s5_append_rawdata", f"""with {LOG} select id, cast(1 as bigint) as source_id, case when id % 3 = 0 then concat('key', id) else concat('path', id) end as raw_object_key,
  'text/html' as raw_payload_type, case when id % 4 = 0 then 'SUCCESS' else status end as status, props as error_message,
  case when id % 5 = 0 then '2030-01-01' else strftime(fetched_at, '%Y-%m-%d') end as fetched_on, '2030-01-01' as created_on from log""")
def append_rawdata(spark, sf_dir):
    i = F.col("id")
    records = crawl_log(spark, sf_dir).select(
        "id", "url", F.when(i % 3 == 0, F.concat(F.lit("key"), i)).otherwise("").alias("raw_object_key"), F.concat(F.lit("path"), i).alias("raw_html_path"),
        F.when(i % 4 == 0, "").otherwise(F.col("status")).alias("crawl_status"), F.col("props").alias("error"),
        F.when(i % 5 == 0, "").otherwise(F.col("fetched_at").cast("string")).alias("fetched_at"), "crawl_run_id")
    out = rawdata.rawdata_record(records, F.lit("2030-01-01 00:00:00").cast("timestamp"))
    return out.select("id", "source_id", "raw_object_key", "raw_payload_type", "status", "error_message",
                      F.date_format("fetched_at", "yyyy-MM-dd").alias("fetched_on"), F.date_format("created_at", "yyyy-MM-dd").alias("created_on"))


@query("s5_merge_into_storage", f"""with {LOG} select source_id, crawl_run_id, url, arg_max(status, (fetched_at, id)) as status, count(*) > 0 as has_id from log group by 1, 2, 3""")
def merge_into_storage(spark, sf_dir):
    """Two batches into an empty table, the second one merged twice as after a crash."""
    folder = work_dir(spark)
    log = _rawdata(crawl_log(spark, sf_dir)).withColumn("id", F.lit(None).cast("bigint"))
    table_dir = f"{folder}/table"
    rawdata.merge_into_storage(spark, log.filter(F.hour("fetched_at") < 12), table_dir, f"{folder}/stage/0")
    late = log.filter(F.hour("fetched_at") >= 12)
    rawdata.merge_into_storage(spark, late, table_dir, f"{folder}/stage/1")
    rawdata.merge_into_storage(spark, late, table_dir, f"{folder}/stage/1")
    return rawdata.read_rawdata(spark, table_dir).select("source_id", "crawl_run_id", "url", "status", F.col("id").isNotNull().alias("has_id"))


@query("s6_sources_table", """with c as (select page_id, concat(case when page_id % 2 = 0 then 'SITE' else 'site' end, page_id % 40) as source_name,
    case page_id % 11 when 0 then 'ftp' else 'rss' end as channel_type from pages)
  select arg_max(source_name, page_id) as source_name, max(page_id) as source_id, true as accepted from c where channel_type <> 'ftp' group by lower(source_name)
  union all select source_name, page_id, false from c where channel_type = 'ftp'""")
def sources_table(spark, sf_dir):
    i = F.col("page_id")
    configs = table(spark, sf_dir, "pages").select(
        i.alias("source_id"), F.concat(F.when(i % 2 == 0, "SITE").otherwise("site"), i % 40).alias("source_name"),
        F.when(i % 11 == 0, "ftp").otherwise("rss").alias("channel_type"), i.alias("config_order"))
    good, bad = config.sources_table(configs)
    shape = ["source_name", "source_id"]
    return good.select(*shape, F.lit(True).alias("accepted")).unionByName(bad.select(*shape, F.lit(False).alias("accepted")))


@query("s6_source_rules", """with p as (select page_id, 'title' as field, ['h1', concat('#t', page_id)] as l from pages union all select page_id, 'strip', [concat('.ad', page_id)] from pages)
  select concat('s', page_id) as source_name, field, unnest(l) as selector, cast(unnest(range(len(l))) as integer) as priority from p""")
def source_rules(spark, sf_dir):
    i = F.col("page_id")
    configs = table(spark, sf_dir, "pages").select(F.concat(F.lit("s"), i).alias("source_name"), F.array(F.lit("h1"), F.concat(F.lit("#t"), i)).alias("title"),
                                                   F.array(F.concat(F.lit(".ad"), i)).alias("strip"))
    return config.rules_from_lists(configs, fields={"title": "title", "strip": "strip"})


@query("s7_migrate_rawdata_002", """with d as (select event_id as id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(concat('rawdata/', event_id))) as h, event_type, user_id from events)
  select id, case when event_type = 'view' then concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-5', substr(h, 14, 3), '-',
      substr('89ab', cast((instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1 as bigint), 1), substr(h, 18, 3), '-', substr(h, 21, 12)) else event_type end as crawl_run_id,
    case when user_id % 3 = 0 then 'application/json' when user_id % 3 = 1 then 'text/html' end as raw_payload_type from d""")
def migrate(spark, sf_dir):
    u = F.col("user_id") % 3
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.when(F.col("event_type") != "view", F.col("event_type")).alias("crawl_run_id"),
        F.when(u == 0, "application/json").alias("raw_payload_type"), F.when(u == 1, "key").alias("raw_object_key"))
    return rawdata.migrate_run_ids(rows).select("id", "crawl_run_id", "raw_payload_type")


@query("s8_landing_tables", f"""with k as (select page_id, {PAGE_V1} as url, {H1} as title, html from pages)
  select page_id, url, title, case when page_id % 10 = 0 then 'TIMEOUT' when page_id % 10 = 1 then 'EMPTY_HTML' else 'SUCCESS' end as status,
    cast(case when page_id % 10 = 0 then 'slow' when page_id % 10 = 1 then 'Nội dung HTML trả về bị rỗng' end as varchar) as error_message from k where page_id % 10 not in (0, 1)
  union all select page_id, url, null, case when page_id % 10 = 0 then 'TIMEOUT' else 'EMPTY_HTML' end, case when page_id % 10 = 0 then 'slow' else 'Nội dung HTML trả về bị rỗng' end
  from k where page_id % 10 in (0, 1)""")
def landing_tables(spark, sf_dir):
    """Fetched pages land as files with a declared schema and are read from there."""
    folder = work_dir(spark)
    k = F.col("page_id") % 10
    fetched = pages(spark, sf_dir).select("page_id", "url", F.when(k == 0, F.lit(None)).when(k == 1, "\n").otherwise(F.col("html")).alias("html"),
                                          F.when(k == 0, "timeout").alias("error_kind"), F.when(k == 0, "slow").alias("error"))
    fetched.write.parquet(folder)
    landed = spark.read.schema("page_id bigint, url string, html string, error_kind string, error string").parquet(folder)
    done = crawl_articles(landed, config.builtin_sources(spark), config.builtin_rules(spark))
    return done.select("page_id", "url", "title", "status", "error_message")
