"""Planned ingestion tables and their metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressroom.functions import urls as U
from pressroom.functions.text import clean_text
from pressroom.operators import ingest
from pressroom.operators.extract import extract_articles
from pressroom.sources.config import builtin_rules
from suite import query
from suite.articles import H1, PARAGRAPHS, generic
from suite.views import LOG, PAGE_BASE, clean_sql, crawl_log, documents, page_base, pages, stamp, table


@query("b1_crawl_items_upsert", f"""with {LOG} select source_id, url as normalized_url, strftime(min(fetched_at), '%Y-%m-%d %H:%M:%S.%f') as first_discovered_at,
  strftime(max(fetched_at), '%Y-%m-%d %H:%M:%S.%f') as last_discovered_at, count(*) filter (status <> 'EMPTY_HTML') as attempt_count,
  arg_max(status, fetched_at) as status, arg_max(crawl_run_id, fetched_at) as last_crawl_run_id from log group by source_id, url""")
def crawl_items(spark, sf_dir):
    """The second half of the month arrives over items built from the first half."""
    seen = crawl_log(spark, sf_dir).select(
        "source_id", F.concat("url", F.lit("?_ga=1")).alias("url"), F.col("fetched_at").alias("seen_at"), "crawl_run_id",
        (F.col("status") != "EMPTY_HTML").alias("attempted"), "status", F.lit(None).cast("string").alias("error_type"), F.col("props").alias("error_message"))
    empty = spark.createDataFrame([], "source_id bigint, normalized_url string, first_discovered_at timestamp, last_discovered_at timestamp, attempt_count bigint, "
                                      "status string, last_crawl_run_id string, last_error_type string, last_error_message string")
    early = ingest.crawl_items_upsert(empty, seen.filter(F.dayofmonth("seen_at") <= 15))
    items = ingest.crawl_items_upsert(early, seen.filter(F.dayofmonth("seen_at") > 15))
    return items.select("source_id", "normalized_url", stamp("first_discovered_at"), stamp("last_discovered_at"), "attempt_count", "status", "last_crawl_run_id")


@query("b2_discovery_metrics", f"""with {LOG}, e as (select concat('s', source_id) as source_name, url, count(*) as n, bool_or(day(fetched_at) = 1) as known from log where status <> 'EMPTY_HTML' group by 1, 2),
  m as (select source_name, sum(n) as valid, sum(case when known then 0 else 1 end) as fresh from e group by 1),
  f as (select concat('s', source_id) as source_name, count(*) filter (status = 'SUCCESS') as feeds_fetched, count(*) filter (status <> 'SUCCESS') as feed_errors,
    count(*) filter (status = 'EMPTY_HTML') as rejected, epoch_us(max(fetched_at)) + 1000000 - epoch_us(min(fetched_at)) as duration_us from log group by 1)
  select source_name, feeds_fetched, feed_errors, duration_us, cast(valid + rejected as bigint) as urls_discovered, cast(fresh as bigint) as urls_new,
    cast(valid - fresh as bigint) as urls_duplicate, rejected as urls_rejected from f join m using (source_name)""")
def discovery_metrics(spark, sf_dir):
    log = crawl_log(spark, sf_dir).withColumn("source_name", F.concat(F.lit("s"), "source_id"))
    feeds = log.select("source_name", (F.col("status") == "SUCCESS").alias("ok"), F.col("fetched_at").alias("started_at"),
                       (F.col("fetched_at") + F.expr("interval 1 second")).alias("finished_at"))
    entries = log.select("source_name", F.when(F.col("status") == "EMPTY_HTML", F.lit("no url")).otherwise(F.col("url")).alias("raw_url"))
    known = log.filter((F.dayofmonth("fetched_at") == 1) & (F.col("status") != "EMPTY_HTML")).select("source_name", "url")
    return ingest.discovery_metrics(feeds, entries, known)


_MARKS = {"captcha": ingest.CAPTCHA_MARKS, "not_found_page": ingest.NOT_FOUND_MARKS, "login_wall": ingest.LOGIN_MARKS}


def _mark_sql(name):
    found = " or ".join(f"contains(lower(title), '{m}')" for m in _MARKS[name])
    gone = " + ".join(f"n - length(replace(lower(content), '{m}', ''))" for m in _MARKS[name])
    return f"case when {found} or ({gone}) >= 0.01 * n and n > 0 then '{name}' end"


@query("b3_article_validation", f"""with d as (select doc_id, {clean_sql('text')} as content, case doc_id % 50 when 0 then '' when 1 then 'Page not found'
    when 2 then 'Captcha' when 3 then 'Please sign in' else source end as title, doc_id % 3001 as paras, doc_id % 25 = 4 as home from documents),
  h as (select *, coalesce(length(content), 0) as n from d)
  select doc_id, list_filter([case when title = '' then 'missing_title' end, case when content is null then 'missing_content' end,
    case when content is not null and n not between 150 and 200000 then 'content_length' end, case when content is not null and paras not between 1 and 2000 then 'paragraph_count' end,
    case when home then 'homepage' end, {_mark_sql('captcha')}, {_mark_sql('not_found_page')}, {_mark_sql('login_wall')}], lambda x: x is not null) as validation_errors from h""")
def article_validation(spark, sf_dir):
    k = F.col("doc_id") % 50
    d = documents(spark, sf_dir).select(
        "doc_id", clean_text("text").alias("content"), (F.col("doc_id") % 3001).alias("paragraph_count"),
        F.when(k == 0, "").when(k == 1, "Page not found").when(k == 2, "Captcha").when(k == 3, "Please sign in").otherwise(F.col("source")).alias("title"),
        F.when(F.col("doc_id") % 25 == 4, "https://e.com/").otherwise(F.concat(F.lit("https://e.com/a/"), "doc_id")).alias("url"))
    return ingest.article_validation(d).select("doc_id", "validation_errors")


def _raw(spark, sf_dir):
    """Table rows and stored objects of the pages; every ninth crawl failed."""
    i = F.col("page_id")
    p = table(spark, sf_dir, "pages")
    key = F.concat(F.lit("raw/"), i, F.lit(".html.gz"))
    rows = p.select(
        i.alias("id"), (i % 5).alias("source_id"), page_base().alias("url"), F.col("url").alias("final_url"), F.lit(200).alias("http_status"),
        key.alias("raw_object_key"), F.lit("text/html").alias("raw_payload_type"), U.content_hash("html").alias("raw_content_hash"),
        F.when(i % 9 == 0, "CONTENT_NOT_FOUND").otherwise("SUCCESS").alias("status"), F.timestamp_seconds(i).alias("fetched_at"), F.timestamp_seconds(i).alias("created_at"))
    files = p.select(key.alias("raw_object_key"), U.content_hash("html").alias("content_hash"), F.octet_length("html").alias("size_bytes"))
    return rows, files


@query("b4_raw_documents_backfill", f"""select page_id as id, page_id % 5 as source_id, {PAGE_BASE} as url, concat('raw/', page_id, '.html.gz') as raw_object_key, 'text/html' as content_type,
  sha256(html) as raw_content_hash, cast(strlen(html) as bigint) as raw_size_bytes from pages where page_id % 9 <> 0""")
def raw_documents(spark, sf_dir):
    rows, files = _raw(spark, sf_dir)
    docs = ingest.raw_documents_backfill(rows, files)
    return docs.select("id", "source_id", "url", "raw_object_key", "content_type", "raw_content_hash", F.col("raw_size_bytes").cast("bigint").alias("raw_size_bytes"))


@query("b4_verify_backfill", """select count(*) as rows_expected, count(*) as rows_written, count(*) as hashes_expected, count(*) as hashes_written,
  cast(0 as bigint) as objects_missing, cast(0 as bigint) as hashes_wrong, true as verified from pages where page_id % 9 <> 0""")
def verify_backfill(spark, sf_dir):
    rows, files = _raw(spark, sf_dir)
    return ingest.verify_backfill(rows, ingest.raw_documents_backfill(rows, files))


@query("b5_articles_build", f"""select page_id as raw_document_id, page_id % 5 as source_id, {H1} as title, sha256(array_to_string({PARAGRAPHS}, chr(10) || chr(10))) as content_hash,
  '1' as extraction_version from pages where page_id % 9 <> 0""")
def articles_build(spark, sf_dir):
    rows, files = _raw(spark, sf_dir)
    extracted = extract_articles(generic(pages(spark, sf_dir)), builtin_rules(spark)).withColumn(
        "raw_object_key", F.concat(F.lit("raw/"), "page_id", F.lit(".html.gz")))
    built = ingest.articles_build(extracted, ingest.raw_documents_backfill(rows, files))
    return built.select("raw_document_id", "source_id", "title", "content_hash", "extraction_version")


_CLASS = "case when http_status in (429, 503) then 'retryable' when id % 10 = 0 then 'permanent' else 'success' end"


def _attempts(spark, sf_dir):
    log = crawl_log(spark, sf_dir)
    code = F.when((F.col("http_status") == 200) & (F.col("id") % 10 == 0), 404).otherwise(F.col("http_status"))
    # Attempts of an item are numbered by its run, three runs to a cycle.
    return log.select("id", F.concat_ws("|", "source_id", "url", "crawl_run_id").alias("crawl_item_id"), F.hour("fetched_at").alias("hour"),
                      code.alias("status_code"), F.when(F.col("status") == "TIMEOUT", "timeout").alias("error_type")).withColumn(
        "attempt_no", F.floor(F.col("hour") / 8).cast("bigint") + 1)


@query("b6_retry_classification", f"with {LOG} select id, {_CLASS} as class from log")
def retry_classification(spark, sf_dir):
    return _attempts(spark, sf_dir).select("id", ingest.classify_retry("status_code", "error_type").alias("class"))


@query("b6_retry_queue", f"""with {LOG}, a as (select id, concat_ws('|', source_id, url, crawl_run_id) as crawl_item_id, hour(fetched_at) // 8 + 1 as attempt_no, {_CLASS} as class from log),
  l as (select crawl_item_id, max(attempt_no) as made, arg_max(class, (attempt_no, id)) as class from a group by 1)
  select crawl_item_id, made + 1 as next_attempt_no from l where class = 'retryable' and made < 3""")
def retry_queue(spark, sf_dir):
    return ingest.retry_queue(_attempts(spark, sf_dir))


@query("b7_politeness_schedule", f"""with {LOG}, q as (select id, source_id, row_number() over (partition by source_id order by fetched_at, id) as slot,
    case source_id when 1 then 2.5 when 2 then 0.5 else 1 end as delay from log)
  select id, slot, strftime(make_timestamp(1704067200000000 + cast((slot - 1) * delay * 1000000 as bigint)), '%Y-%m-%d %H:%M:%S.%f') as planned_at from q""")
def politeness(spark, sf_dir):
    queue = crawl_log(spark, sf_dir).select("id", F.concat(F.lit("d"), "source_id").alias("domain"), F.col("fetched_at").alias("queued_at"))
    # A policy per domain, read off the domains in the data.
    delays = table(spark, sf_dir, "events").select(F.concat(F.lit("d"), F.col("user_id") % 5 + 1).alias("domain")).distinct().withColumn(
        "min_delay_seconds", F.when(F.col("domain") == "d1", 2.5).when(F.col("domain") == "d2", 0.5))
    plan = ingest.politeness_schedule(queue, delays, F.timestamp_seconds(F.lit(1704067200)), order=["queued_at", "id"])
    return plan.select("id", "slot", stamp("planned_at"))


def _measured(spark, sf_dir):
    log = crawl_log(spark, sf_dir)
    return log.select("source_id", "http_status", F.when(F.col("status") == "TIMEOUT", "timeout").alias("error_type"), "status",
                      (F.col("value") > 5).alias("is_valid"), (F.col("id") % 7 == 0).alias("is_duplicate"), F.col("value").alias("response_time_ms"))


@query("b8_reliability_metrics", f"""with {LOG} select source_id, count(*) as attempts, count(*) filter (http_status = 200) / count(*) as fetch_success_rate,
  count(*) filter (http_status = 200) as status_2xx, cast(0 as bigint) as status_3xx, count(*) filter (http_status = 429) as status_4xx, count(*) filter (http_status = 503) as status_5xx,
  count(*) filter (status = 'TIMEOUT') as timeouts, count(*) filter (http_status = 429) as rate_limited, cast(0 as bigint) as forbidden,
  count(*) filter (status = 'SUCCESS') / count(*) filter (http_status = 200) as parse_success_rate, count(*) filter (not value > 5) / count(*) filter (status = 'SUCCESS') as validation_failure_rate,
  count(*) filter (id % 7 = 0) as duplicates, round(avg(value), 6) as average_latency_ms from log group by source_id""")
def reliability(spark, sf_dir):
    return ingest.reliability_metrics(_measured(spark, sf_dir)).withColumn("average_latency_ms", F.round("average_latency_ms", 6))


@query("b8_status_distribution", f"""with {LOG}, a as (select source_id, case id % 50 when 0 then 301 when 1 then 404 when 2 then 500 when 3 then null else http_status end as http_status from log)
  select source_id, cast(http_status as bigint) as http_status, count(*) as attempts from a group by all""")
def status_distribution(spark, sf_dir):
    k = F.col("id") % 50
    status = F.when(k == 0, 301).when(k == 1, 404).when(k == 2, 500).when(k != 3, F.col("http_status")).cast("bigint")
    return ingest.status_distribution(crawl_log(spark, sf_dir).withColumn("http_status", status))


@query("b9_mvp_metrics", f"""with {LOG} select count(*) as crawls, count(*) filter (status in ('SUCCESS', 'CONTENT_NOT_FOUND')) / count(*) as crawl_success_rate,
  count(*) filter (status = 'SUCCESS') / count(*) filter (status in ('SUCCESS', 'CONTENT_NOT_FOUND')) as parse_success_rate, round(avg(value), 6) as average_time_ms,
  count(*) filter (status in ('EMPTY_HTML', 'CONTENT_NOT_FOUND')) / count(*) as empty_rate, round(avg(length(props)) filter (status = 'SUCCESS'), 6) as average_length,
  count(*) filter (status = 'TIMEOUT') / count(*) as error_rate from log""")
def mvp_metrics(spark, sf_dir):
    m = ingest.mvp_metrics(crawl_log(spark, sf_dir).withColumns({"duration_ms": F.col("value"), "content": F.col("props")}))
    return m.withColumns({c: F.round(c, 6) for c in ("average_time_ms", "average_length")})


@query("b10_retention", f"""with {LOG} select id from log where case status when 'SUCCESS' then fetched_at < timestamp '2024-01-21 00:00:00'
  when 'TIMEOUT' then fetched_at < timestamp '2024-01-29 00:00:00' when 'EMPTY_HTML' then fetched_at < timestamp '2024-01-30 00:00:00' else false end
  and id not in (select id from log where value > 40)""")
def retention(spark, sf_dir):
    log = crawl_log(spark, sf_dir)
    items = log.select("id", F.col("status").alias("object_class"), F.col("id").cast("string").alias("object_key"), F.col("fetched_at").alias("stored_at"))
    # One policy row per class found in the data; the class without a limit is kept.
    days = F.when(F.col("object_class") == "SUCCESS", 10).when(F.col("object_class") == "TIMEOUT", 2).when(F.col("object_class") == "EMPTY_HTML", 1)
    policy = items.select("object_class").distinct().withColumn("keep_days", days).filter(F.col("keep_days").isNotNull())
    used = log.filter(F.col("value") > 40).select(F.col("id").cast("string").alias("object_key"))
    return ingest.expired(items, policy, F.lit("2024-01-31 00:00:00").cast("timestamp"), used).select("id")


@query("b11_content_addressed_key", """with d as (select concat('raw/my_site/2024/01/0', 1 + doc_id % 2, '/', sha256(text), '.html.gz') as object_key, doc_id from documents)
  select object_key, min(doc_id) as doc_id from d group by object_key""")
def content_addressed(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", F.lit("my site").alias("source_name"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("url"),
                                        F.col("text").alias("html"), F.timestamp_seconds(F.lit(1704067200) + 86400 * (F.col("doc_id") % 2)).alias("fetched_at"))
    return ingest.content_addressed(d).select("object_key", "doc_id")


@query("b11_verify_checksums", """select concat('raw/', sha256(text), '.html.gz') as object_key, sha256(text) as expected, sha256(concat(text, '!')) as actual from documents where doc_id % 10 = 0""")
def verify_checksums(spark, sf_dir):
    i = F.col("doc_id")
    d = documents(spark, sf_dir).select(F.concat(F.lit("raw/"), U.content_hash("text"), F.lit(".html.gz")).alias("object_key"),
                                        F.concat("text", F.when(i % 10 == 0, "!").otherwise("")).alias("html"))
    return ingest.verify_checksums(d)
