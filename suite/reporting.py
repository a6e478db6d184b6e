"""Counts, statistics and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressroom.functions import urls as U
from pressroom.operators import reconcile, reports
from pressroom.plans import jobs
from suite import query
from suite.views import LOG, crawl_log, stamp, stamp_sql, table


@query("a1_count_rawdata", f"with {LOG} select status, count(*) as n_rows from log group by status union all select 'ALL', count(*) from log")
def count_rawdata(spark, sf_dir):
    log = crawl_log(spark, sf_dir)
    return reports.count_by_status(log).unionByName(reports.count_rawdata(log).select(F.lit("ALL").alias("status"), "n_rows"))


@query("a1_count_success", f"with {LOG} select count(*) as n_rows from log where status = 'SUCCESS'")
def count_success(spark, sf_dir):
    return reports.count_rawdata(crawl_log(spark, sf_dir), "SUCCESS")


@query("a2_latest_rawdata", f"with {LOG} select id, source_id, url, status, {stamp_sql('fetched_at')} from log order by id desc limit 10")
def latest_rawdata(spark, sf_dir):
    return reports.latest_rawdata(crawl_log(spark, sf_dir)).select("id", "source_id", "url", "status", stamp("fetched_at"))


@query("a3_run_stats", f"""with {LOG}, o as (select source_id, case when http_status = 429 then 'SKIPPED_EXISTING' else status end as status from log)
  select source_id, grouping(source_id) = 1 as is_total, count(*) as discovered, count(*) filter (status = 'SKIPPED_EXISTING') as skipped,
  count(*) filter (status = 'SUCCESS') as success, count(*) filter (status not in ('SKIPPED_EXISTING', 'SUCCESS')) as failed from o group by rollup(source_id)""")
def run_stats(spark, sf_dir):
    log = crawl_log(spark, sf_dir).withColumn("status", F.when(F.col("http_status") == 429, reports.SKIPPED).otherwise(F.col("status")))
    return reports.run_stats(log, "source_id")


@query("a4_batch_failures", f"with {LOG} select crawl_run_id, concat(url, ': ', status) as line from log where status <> 'SUCCESS'")
def batch_failures(spark, sf_dir):
    return reports.failure_lines(crawl_log(spark, sf_dir)).select("crawl_run_id", "line")


@query("a4_batch_outcome", f"""with {LOG} select crawl_run_id, count(*) as urls, count(*) filter (status <> 'SUCCESS') as failures,
  count(*) filter (status <> 'SUCCESS') > 0 as batch_failed from log group by crawl_run_id""")
def batch_outcome(spark, sf_dir):
    return reports.batch_outcome(crawl_log(spark, sf_dir))


# Stored files and their table rows, derived from the pages: some files are missing, some rows, some hashes are wrong.
_STORE = """files as (select page_id, concat('crawl_data/raw/s/', page_id, '.html.gz') as raw_object_key, sha256(html) as content_hash from pages where page_id % 7 <> 0),
  rows as (select page_id as id, cast(page_id % 3 as bigint) as source_id, concat('run-', page_id % 4) as crawl_run_id, concat('u', page_id) as url,
      case when page_id % 13 = 0 then concat('../', page_id) else concat('crawl_data/raw/s/', page_id, '.html.gz') end as raw_object_key,
      case when page_id % 11 = 0 then 'bad' else sha256(html) end as raw_content_hash from pages where page_id % 5 <> 0
    union all select page_id + 1000000000, cast(page_id % 3 as bigint), concat('run-', page_id % 4), concat('u', page_id), null, null from pages where page_id % 17 = 3),
  meta as (select concat('m/', page_id) as metadata_path, page_id % 19 <> 0 as readable, case when page_id % 2 = 0 then 2 else 1 end as version,
      case when page_id % 23 <> 0 then concat('crawl_data/raw/s/', page_id, '.html.gz') end as raw_object_key, case when page_id % 29 = 0 then 'old' end as expected, page_id from pages),
  newest as (select raw_object_key, max(id) as id from rows where raw_object_key is not null group by 1),
  good as (select metadata_path, m.raw_object_key, expected, n.id as database_id, version from meta m left join newest n using (raw_object_key) where readable),
  refs as (select metadata_path, raw_object_key, expected, database_id from good where raw_object_key is not null
    union all select null, raw_object_key, raw_content_hash, id from rows where raw_object_key is not null),
  findings as (
    select 'raw_files_without_database_row' as category, null as metadata_path, raw_object_key, null as database_id, null as actual from files where raw_object_key not in (select raw_object_key from newest)
    union all select 'database_rows_without_raw_file', metadata_path, raw_object_key, database_id, null from refs where raw_object_key not in (select raw_object_key from files)
    union all select 'hash_mismatches', metadata_path, raw_object_key, database_id, content_hash from refs join files using (raw_object_key) where expected <> content_hash
    union all select case when version = 1 then 'legacy_' else '' end || 'metadata_without_database_reference', metadata_path, raw_object_key, null, null from good where database_id is null
    union all select 'metadata_without_database_reference', metadata_path, null, null, null from meta where not readable
    union all select 'metadata_without_raw_reference', metadata_path, null, null, null from good where raw_object_key is null
    union all select 'database_duplicate_run_urls', null, raw_object_key, id, null from rows where (source_id, crawl_run_id, url) in (select (source_id, crawl_run_id, url) from rows group by source_id, crawl_run_id, url having count(*) > 1))"""
_FINDING = "metadata_path, raw_object_key, cast(database_id as bigint) as database_id, actual"


def _store(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    i = F.col("page_id")
    key = F.concat(F.lit("crawl_data/raw/s/"), i, F.lit(".html.gz"))
    files = p.filter(i % 7 != 0).select(key.alias("raw_object_key"), U.content_hash("html").alias("content_hash"))
    base = p.select(i, (i % 3).alias("source_id"), F.concat(F.lit("run-"), i % 4).alias("crawl_run_id"), F.concat(F.lit("u"), i).alias("url"), "html")
    rows = base.filter(i % 5 != 0).select(
        i.alias("id"), "source_id", "crawl_run_id", "url", F.when(i % 13 == 0, F.concat(F.lit("../"), i)).otherwise(key).alias("raw_object_key"),
        F.when(i % 11 == 0, "bad").otherwise(U.content_hash("html")).alias("raw_content_hash"))
    retries = base.filter(i % 17 == 3).select(
        (i + 1000000000).alias("id"), "source_id", "crawl_run_id", "url", F.lit(None).cast("string").alias("raw_object_key"),
        F.lit(None).cast("string").alias("raw_content_hash"))
    readable = i % 19 != 0
    meta = p.select(
        F.concat(F.lit("m/"), i).alias("metadata_path"), readable.alias("readable"),
        F.when(readable, F.when(i % 2 == 0, 2).otherwise(1)).alias("schema_version"),
        F.when(readable & (i % 23 != 0), key).alias("raw_object_key"), F.when(readable & (i % 29 == 0), "old").alias("raw_content_hash"))
    return meta, rows.unionByName(retries), files


def _report_query(name, category, build):
    @query(name, f"with {_STORE} select {_FINDING} from findings where category = '{category}'")
    def run(spark, sf_dir):
        found = build(*_store(spark, sf_dir))
        return found.filter(F.col("category") == category).select("metadata_path", "raw_object_key", "database_id", "actual")


_report_query("a5_duplicate_run_urls", "database_duplicate_run_urls", lambda meta, rows, files: reconcile.duplicate_run_urls(rows))
_report_query("a6_raw_without_db", "raw_files_without_database_row", lambda meta, rows, files: reconcile.raw_without_row(files, rows))
_report_query("a7_db_without_raw", "database_rows_without_raw_file", lambda meta, rows, files: reconcile.rows_without_raw(meta, rows, files))
_report_query("a8_hash_mismatches", "hash_mismatches", lambda meta, rows, files: reconcile.hash_mismatches(meta, rows, files))
_report_query("a9_metadata_without_db", "metadata_without_database_reference", lambda meta, rows, files: reconcile.metadata_without_row(meta, rows))
_report_query("a10_legacy_metadata_without_db", "legacy_metadata_without_database_reference", lambda meta, rows, files: reconcile.metadata_without_row(meta, rows))
_report_query("a11_metadata_without_raw_ref", "metadata_without_raw_reference", lambda meta, rows, files: reconcile.metadata_without_raw_reference(meta))


@query("a5_duplicate_run_urls_log", f"""with {LOG} select id as database_id, source_id, crawl_run_id, url from log
  where (source_id, crawl_run_id, url) in (select (source_id, crawl_run_id, url) from log group by source_id, crawl_run_id, url having count(*) > 1)""")
def duplicate_run_urls_log(spark, sf_dir):
    return reconcile.duplicate_run_urls(crawl_log(spark, sf_dir)).select("database_id", "source_id", "crawl_run_id", "url")


@query("a12_reconcile_report", f"with {_STORE} select category, {_FINDING} from findings")
def reconcile_report(spark, sf_dir):
    return reconcile.reconcile_report(*_store(spark, sf_dir)).select("category", "metadata_path", "raw_object_key", "database_id", "actual")


@query("a12_reconcile_summary", f"with {_STORE} select category, count(*) as findings from findings group by category")
def reconcile_summary(spark, sf_dir):
    return reconcile.report_summary(reconcile.reconcile_report(*_store(spark, sf_dir)))


@query("e3_reconcile_stored", f"with {_STORE} select category, {_FINDING} from findings")
def reconcile_stored(spark, sf_dir):
    """The whole job: sidecars and object hashes are staged once, then checked."""
    return jobs.reconcile_stored(*_store(spark, sf_dir)).select("category", "metadata_path", "raw_object_key", "database_id", "actual")


@query("a13_notebook_summary", f"""with {LOG} select url, status, case when status = 'SUCCESS' then props end as title, length(props) as content_chars, cast(null as varchar) as raw_object_key,
  list_filter(['url', 'status', case when status = 'SUCCESS' then 'title' end, 'content'], lambda x: x is not null) as metadata_fields from log""")
def record_summary(spark, sf_dir):
    log = crawl_log(spark, sf_dir)
    records = log.select("url", "status", F.when(F.col("status") == "SUCCESS", F.col("props")).alias("title"), F.col("props").alias("content"),
                         F.lit(None).cast("string").alias("raw_object_key"))
    return reports.record_summary(records)
