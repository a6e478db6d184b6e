"""Source lookup, duplicates, skip lists and upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressroom.functions import urls as U
from pressroom.operators import dedupe
from pressroom.sources.config import small_table
from pressroom.schemas import SOURCES
from suite import query
from suite.views import LOG, PAGE_HOST, PAGE_V1, crawl_log, stamp, stamp_sql, table

LOG_COLUMNS = "id, source_id, crawl_run_id, url, status"


def _host_sources(spark):
    """Three sources over the hosts of the page table; the first two overlap on purpose."""
    rows = [
        {"source_id": 11, "source_name": "Blogs", "channel_type": "rss", "domains": ["blog.ththan.example.net", "blog.tionsh.example.net"], "config_order": 0},
        {"source_id": 12, "source_name": "Net", "channel_type": "rss", "domains": ["example.net", "ththan.example.net"], "config_order": 1},
        {"source_id": 13, "source_name": "Org", "channel_type": "html", "domains": ["EXAMPLE.org"], "config_order": 2},
    ]
    return small_table(spark, rows, SOURCES)


_RESOLVED = f"""h as (select page_id, {PAGE_HOST} as host from pages),
  r as (select page_id, host, case when host in ('blog.ththan.example.net', 'blog.tionsh.example.net') or host like '%.blog.ththan.example.net' or host like '%.blog.tionsh.example.net' then 'blogs'
    when host = 'example.net' or host like '%.example.net' then 'net' when host = 'example.org' or host like '%.example.org' then 'org' end as by_host,
    case when page_id % 10 = 0 then 'net' end as by_name, case when page_id % 10 = 1 then 'newcomer' end as unknown_name from h)
  select page_id, coalesce(by_name, by_host, 'generic') as rule_set,
    cast(case coalesce(by_name, by_host) when 'blogs' then 11 when 'net' then 12 when 'org' then 13 else 999 end as bigint) as source_id,
    case coalesce(by_name, by_host) when 'blogs' then 'Blogs' when 'net' then 'Net' when 'org' then 'Org'
      else coalesce(unknown_name, split_part(replace(host, 'www.', ''), '.', 1)) end as source_name from r"""


def _named_pages(spark, sf_dir):
    i = F.col("page_id") % 10
    return table(spark, sf_dir, "pages").select("page_id", "url", F.when(i == 0, " NET ").when(i == 1, "newcomer").otherwise("").alias("given"))


@query("j1_resolve_source", f"with {_RESOLVED}")
def resolve_source(spark, sf_dir):
    out = dedupe.resolve_source(_named_pages(spark, sf_dir), _host_sources(spark), named="given")
    return out.select("page_id", "rule_set", "source_id", "source_name")


@query("j1_resolve_source_by_join", f"with {_RESOLVED}")
def resolve_source_by_join(spark, sf_dir):
    """The path for domain lists too long for a map."""
    out = dedupe.resolve_source(_named_pages(spark, sf_dir), _host_sources(spark), named="given", in_row_domains=0)
    return out.select("page_id", "rule_set", "source_id", "source_name")


@query("j2_dedupe_first_wins", f"""with {LOG}, r as (select {LOG_COLUMNS}, row_number() over (partition by source_id, url order by fetched_at, id) as rn from log)
  select {LOG_COLUMNS} from r where rn = 1""")
def dedupe_first_wins(spark, sf_dir):
    log = crawl_log(spark, sf_dir).withColumn("landed", F.concat("url", F.lit("?utm_source=x"), F.lit("#"), "id"))
    keyed = log.withColumn("url", U.normalize_v1("landed"))
    return dedupe.dedupe_first_wins(keyed, ["fetched_at", "id"], source="source_id").select(*LOG_COLUMNS.split(", "))


def _artifacts(spark, sf_dir):
    """Runs of the first half of the month as stored artifacts of four of the five sources."""
    log = crawl_log(spark, sf_dir).filter((F.dayofmonth("fetched_at") <= 15) & (F.col("source_id") != 5))
    return log.select(F.concat(F.lit("s"), "source_id").alias("source_name"), U.short_hash("url").alias("url_hash"),
                      F.col("fetched_at").alias("modified_at"), F.lpad(F.col("id").cast("string"), 12, "0").alias("metadata_path"),
                      (F.col("status") != "TIMEOUT").alias("readable"))


_ARTIFACTS = """a as (select concat('s', source_id) as source_name, url, fetched_at, id, status <> 'TIMEOUT' as readable
    from log where day(fetched_at) <= 15 and source_id <> 5),
  own as (select source_name, url, arg_max(readable, (fetched_at, id)) as readable from a group by 1, 2),
  anywhere as (select url, arg_max(readable, (fetched_at, id)) as readable from a group by 1),
  c as (select id, concat('s', source_id) as source_name, case when source_id = 5 and id % 2 = 0 then concat('https://example.com/a/', id % 150, '.html') else url end as url
    from log where day(fetched_at) > 15)"""


@query("j3_skip_any_artifact", f"""with {LOG}, {_ARTIFACTS} select id, source_name, url from c where not exists
    (select 1 from own where own.source_name = c.source_name and own.url = c.url and readable)
    and (c.source_name in (select source_name from a) or not exists (select 1 from anywhere where anywhere.url = c.url and readable))""")
def skip_any_artifact(spark, sf_dir):
    log = crawl_log(spark, sf_dir).filter(F.dayofmonth("fetched_at") > 15)
    moved = F.when((F.col("source_id") == 5) & (F.col("id") % 2 == 0), F.concat(F.lit("https://example.com/a/"), F.col("id") % 150, F.lit(".html"))).otherwise(F.col("url"))
    candidates = log.select("id", F.concat(F.lit("s"), "source_id").alias("source_name"), moved.alias("url")).withColumn("url_hash", U.short_hash("url"))
    return dedupe.skip_any_artifact(candidates, _artifacts(spark, sf_dir)).select("id", "source_name", "url")


_SPLIT = "old as (select * from log where day(fetched_at) <= 3), new as (select * from log where day(fetched_at) > 3)"


def _halves(spark, sf_dir):
    log = crawl_log(spark, sf_dir)
    return log.filter(F.dayofmonth("fetched_at") <= 3), log.filter(F.dayofmonth("fetched_at") > 3)


@query("j4_url_exists_success", f"""with {LOG}, {_SPLIT} select {LOG_COLUMNS}, true as known from new where exists (select 1 from old where old.url = new.url and old.status = 'SUCCESS')
  union all select {LOG_COLUMNS}, false from new where not exists (select 1 from old where old.url = new.url and old.source_id = new.source_id and old.status = 'SUCCESS')""")
def url_exists(spark, sf_dir):
    old, new = _halves(spark, sf_dir)
    shape = LOG_COLUMNS.split(", ")
    return dedupe.url_exists(new, old).select(*shape, F.lit(True).alias("known")).unionByName(
        dedupe.url_missing(new, old, per_source=True).select(*shape, F.lit(False).alias("known")))


@query("j5_latest_artifact", f"""with {LOG}, a as (select concat('s', source_id) as source_name, substr(sha256(url), 1, 16) as url_hash, id, fetched_at from log
    where day(fetched_at) <= 15 and source_id <> 5)
  select source_name, url_hash, arg_max(id, (fetched_at, id)) as id from a group by 1, 2""")
def latest_artifact(spark, sf_dir):
    latest = dedupe.latest_artifact(_artifacts(spark, sf_dir), ["source_name", "url_hash"])
    return latest.select("source_name", "url_hash", F.col("metadata_path").cast("bigint").alias("id"))


@query("j6_skip_done_in_run", f"""with {LOG}, u as (select distinct source_id, crawl_run_id, url from log),
  d as (select source_id, crawl_run_id, url, min(id) as existing_id from log where status = 'SUCCESS' group by 1, 2, 3)
  select source_id, crawl_run_id, url, existing_id, case when existing_id is null then 'PENDING' else 'SKIPPED_EXISTING' end as action
  from u left join d using (source_id, crawl_run_id, url)""")
def skip_done_in_run(spark, sf_dir):
    log = crawl_log(spark, sf_dir)
    return dedupe.skip_done_in_run(log.select("source_id", "crawl_run_id", "url").distinct(), log)


def _rawdata(log):
    return log.select("id", "source_id", "url", F.concat("url", F.lit("#f")).alias("final_url"), F.col("http_status").cast("int"),
                      F.lit(None).cast("string").alias("raw_object_key"), F.lit("text/html").alias("raw_payload_type"),
                      F.lit(None).cast("string").alias("raw_content_hash"), "crawl_run_id", "status", F.lit(None).cast("string").alias("error_type"),
                      F.col("props").alias("error_message"), "fetched_at", F.col("fetched_at").alias("created_at"))


@query("j7_upsert_rawdata", f"""with {LOG} select min(id) as id, source_id, crawl_run_id, url, arg_max(status, (fetched_at, id)) as status,
  arg_max(props, (fetched_at, id)) as error_message, strftime(min(fetched_at), '%Y-%m-%d %H:%M:%S.%f') as created_at,
  strftime(max(fetched_at), '%Y-%m-%d %H:%M:%S.%f') as fetched_at from log group by source_id, crawl_run_id, url""")
def upsert_rawdata(spark, sf_dir):
    """The later rows of every key arrive as a batch over the earlier ones."""
    log = _rawdata(crawl_log(spark, sf_dir))
    merged = dedupe.upsert_rawdata(log.filter(F.hour("fetched_at") < 12), log.filter(F.hour("fetched_at") >= 12))
    return merged.select("id", "source_id", "crawl_run_id", "url", "status", "error_message", stamp("created_at"), stamp("fetched_at"))


@query("j7_assign_ids", f"""with {LOG} select count(*) as n, min(id) as distinct_ids_from, max(id) as distinct_ids_to, count(distinct id) as distinct_ids,
  0 as misplaced from (select row_number() over (order by source_id, crawl_run_id, url) + 1000 as id from (select distinct source_id, crawl_run_id, url from log))""".replace("0 as misplaced", "cast(0 as bigint) as misplaced"))
def assign_ids(spark, sf_dir):
    """New rows get consecutive ids after the highest one, in order of their minute."""
    log = _rawdata(crawl_log(spark, sf_dir)).withColumn("id", F.lit(None).cast("bigint"))
    numbered = dedupe.assign_ids(dedupe.upsert_rawdata(log.filter(F.lit(False)), log), 1000)
    late = numbered.groupBy(F.date_trunc("minute", "fetched_at").alias("m")).agg(F.max("id").alias("hi"), F.min("id").alias("lo"), F.count(F.lit(1)).alias("c"))
    span = late.agg(F.sum(F.when(F.col("hi") - F.col("lo") + 1 != F.col("c"), 1).otherwise(0)).cast("bigint").alias("misplaced"), F.lit(1).alias("k"))
    totals = numbered.agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("distinct_ids_from"), F.max("id").alias("distinct_ids_to"),
                          F.countDistinct("id").alias("distinct_ids"), F.lit(1).alias("k"))
    return totals.join(span, "k").drop("k")


@query("j8_immutable_first_write", f"""with {LOG}, r as (select *, row_number() over (partition by source_id, url, crawl_run_id order by fetched_at, sha256(props)) as rn from log
    where (source_id, url, crawl_run_id) not in (select source_id, url, crawl_run_id from log where hour(fetched_at) < 2))
  select id, source_id, url, crawl_run_id from r where rn = 1""")
def immutable_first_write(spark, sf_dir):
    log = crawl_log(spark, sf_dir).withColumn("raw_content_hash", U.content_hash("props"))
    keys = ["source_id", "url", "crawl_run_id"]
    stored = log.filter(F.hour("fetched_at") < 2)
    return dedupe.immutable_first_write(stored, log, keys).select("id", *keys)


@query("j9_get_by_id", f"with {LOG} select {LOG_COLUMNS}, {stamp_sql('fetched_at')} from log where id = 77")
def get_by_id(spark, sf_dir):
    return dedupe.get_by_id(crawl_log(spark, sf_dir), 77).select(*LOG_COLUMNS.split(", "), stamp("fetched_at"))


@query("j10_db_by_object_key", f"""with {LOG} select url as raw_object_key, max(id) as id, arg_max(status, id) as status from log where status <> 'EMPTY_HTML' group by url""")
def by_object_key(spark, sf_dir):
    log = crawl_log(spark, sf_dir).withColumn("raw_object_key", F.when(F.col("status") == "EMPTY_HTML", F.lit("")).otherwise(F.col("url")))
    return dedupe.by_object_key(log).select("raw_object_key", "id", "status")


@query("j2_dedupe_pages", f"select min(page_id) as page_id, {PAGE_V1} as url from pages group by {PAGE_V1}")
def dedupe_pages(spark, sf_dir):
    """Every page landed twice, the second time with tracking; the URL hash alone decides."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    again = p.withColumn("url", F.concat(U.normalize_v1("url"), F.when(F.instr(U.normalize_v1("url"), "?") > 0, "&").otherwise("?"), F.lit("fbclid=1")))
    landed = p.withColumn("copy", F.lit(0)).unionByName(again.withColumn("copy", F.lit(1))).withColumn("url", U.normalize_v1("url"))
    return dedupe.dedupe_first_wins(landed, ["page_id", "copy"], source="url").select("page_id", "url")
