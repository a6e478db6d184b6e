"""URL, id, text and date functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressroom.functions import ids as I
from pressroom.functions import text as T
from pressroom.functions import urls as U
from pressroom.operators.discover import parse_url_list
from suite import query
from suite.views import BLANKS, PAGE_BASE, PAGE_HOST, PAGE_V1, clean_sql, documents, page_base, pages, table


def _variants(spark, sf_dir):
    """Each page URL as landed, with many parameters, and in shouting case with user, port and fragment."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", page_base().alias("base"))
    host, path = U.netloc("base"), U.path("base")
    many = F.concat("base", F.lit("?id="), "page_id", F.lit("&UTM_Source=x&b=&fbclid=1&q=a+b%2Fc&_ga=7#x"))
    loud = F.concat(F.lit(" HTTPS://user:pw@"), F.upper(host), F.lit(":443"), path, F.lit("#top "))
    return p.select("page_id", F.posexplode(F.array("url", many, loud)).alias("kind", "raw")).withColumn("kind", F.col("kind").cast("bigint"))


_VARIANTS = f"""v as (
  select page_id, url, {PAGE_BASE} as base, {PAGE_HOST} as host, regexp_extract({PAGE_BASE}, '^[a-z]+://[^/]*(.*)$', 1) as path from pages),
  k as (select * from v, (values (0), (1), (2)) t(kind))"""


@query("u1_normalize_url_v1", f"""with {_VARIANTS} select page_id, cast(kind as bigint) as kind, case kind when 0 then {PAGE_V1}
  when 1 then concat(base, '?id=', page_id, '&b=&q=a+b%2Fc&_ga=7') else concat('https://user:pw@', upper(host), ':443', path) end as url from k""")
def normalize_v1(spark, sf_dir):
    return _variants(spark, sf_dir).select("page_id", "kind", U.normalize_v1("raw").alias("url"))


_V2 = f"""case kind when 0 then case when path = '' then concat({PAGE_V1}, '/') else {PAGE_V1} end
  when 1 then concat(base, '?id=', page_id, '&b=&q=a+b%2Fc') else concat('https://', lower(host), case when path = '' then '/' else path end) end"""


@query("u2_normalize_url_v2", f"with {_VARIANTS} select page_id, cast(kind as bigint) as kind, {_V2} as url from k")
def normalize_v2(spark, sf_dir):
    return _variants(spark, sf_dir).select("page_id", "kind", U.normalize_v2("raw").alias("url"))


@query("u3_url_is_valid", f"""with v as (select page_id, {PAGE_HOST} as host from pages)
  select page_id, cast(kind as bigint) as kind, ok from v, (values (0, true), (1, true), (2, false), (3, false), (4, false), (5, false), (6, true)) t(kind, ok)""")
def url_is_valid(spark, sf_dir):
    p = table(spark, sf_dir, "pages").withColumn("host", U.netloc("url"))
    shapes = F.array(
        F.col("url"), F.concat(F.lit("HTTP://"), "host", F.lit(":8080")), F.concat(F.lit("ftp://"), "host", F.lit("/a")),
        F.concat("host", F.lit("/a")), F.concat(F.lit("http://"), "host", F.lit(":99999/")), F.concat(F.lit("http://"), "host", F.lit(":8o/")),
        F.concat(F.lit("https://[::1]:"), F.col("page_id") % 1000 + 1, F.lit("/"), "host"),
    )
    return p.select("page_id", F.posexplode(shapes).alias("kind", "raw")).select(
        "page_id", F.col("kind").cast("bigint").alias("kind"), U.is_valid("raw").alias("ok"))


@query("u4_url_hash", f"with {_VARIANTS} select page_id, substr(sha256({PAGE_V1}), 1, 16) as hash_v1, substr(sha256({_V2}), 1, 16) as hash_v2 from k where kind = 0")
def url_hash(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.url_hash_v1("url").alias("hash_v1"), U.url_hash_v2("url").alias("hash_v2"))


@query("u5_source_host_match", f"""with h as (select page_id, {PAGE_HOST} as host from pages) select page_id, domain,
  host = domain or host like concat('%.', domain) as plain, false as with_port from h, (values ('example.com'), ('example.net'), ('ample.org')) t(domain)""")
def host_match(spark, sf_dir):
    p = table(spark, sf_dir, "pages").withColumn("host", U.netloc("url"))
    each = p.select("page_id", "host", F.explode(F.array(F.lit("example.com"), F.lit("example.net"), F.lit("ample.org"))).alias("domain"))
    return each.select("page_id", "domain", U.host_matches("host", "domain").alias("plain"),
                       U.host_matches(F.concat("host", F.lit(":80")), "domain").alias("with_port"))


@query("u6_infer_source_name", f"select page_id, split_part(replace({PAGE_HOST}, 'www.', ''), '.', 1) as source_name from pages")
def infer_source_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.infer_source_name("url").alias("source_name"))


_LINK_KINDS = "(values (0, '/tag/x1.html', false), (1, '/story.html', true), (2, '/news/2024', true), (3, '/about-us-today', false), (4, '', false), (5, '/feedback9', false), (6, '/plain', false))"


@query("u7_is_article_link", f"""with h as (select page_id, {PAGE_HOST} as host, url from pages)
  select page_id, cast(kind as bigint) as kind, ok and (host = 'example.com' or host like '%.example.com') as is_article from h, {_LINK_KINDS} t(kind, tail, ok)
  union all select page_id, 7, (host like '%.example.com') and (regexp_matches(path, '[0-9]') or length(trim(path, '/')) > 30 or path like '%.html')
  from (select page_id, host, regexp_extract({PAGE_BASE}, '^[a-z]+://[^/]*(.*)$', 1) as path from h)""")
def is_article_link(spark, sf_dir):
    p = table(spark, sf_dir, "pages").withColumn("origin", F.concat(F.lit("https://"), U.netloc("url")))
    tails = ["/tag/x1.html", "/story.html", "/news/2024", "/about-us-today", "", "/feedback9", "/plain"]
    links = F.array(*[F.concat("origin", F.lit(t)) for t in tails], page_base())
    return p.select("page_id", F.posexplode(links).alias("kind", "link")).select(
        "page_id", F.col("kind").cast("bigint").alias("kind"), U.is_article_link("link", F.array(F.lit("example.com"))).alias("is_article"))


@query("u8_url_join", f"""with b as (select page_id, {PAGE_BASE} as base, {PAGE_V1} as v1, url,
    regexp_extract(url, '^[a-z]+://[^/?#]*') as origin, regexp_extract(url, '^([a-z]+):', 1) as scheme from pages)
  select page_id, cast(kind as bigint) as kind, case kind when 0 then concat(origin, '/abs/x?k=1') when 1 then concat(scheme, '://h.example/p')
    when 2 then concat(base, '?k=1') when 3 then 'https://z.example/q' when 4 then concat(origin, '/up')
    when 5 then concat(regexp_replace(base, '[^/]*$', ''), 'side/x') end as url
  from b, (values (0), (1), (2), (3), (4), (5)) t(kind)""")
def url_join(spark, sf_dir):
    refs = ["/abs/./y/../x?k=1", "//h.example/p", "?k=1", "https://z.example/q", "../../../../../up", "side/./x"]
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.posexplode(F.array(*[F.lit(r) for r in refs])).alias("kind", "ref"))
    return p.select("page_id", F.col("kind").cast("bigint").alias("kind"), U.url_join("url", "ref").alias("url"))


@query("u9_safe_source_name", f"""select doc_id, coalesce(nullif(regexp_replace(regexp_replace(text, '^{BLANKS}|{BLANKS}$', '', 'g'),
  '[^A-Za-z0-9_.-]+', '_', 'g'), ''), 'unknown') as name from documents""")
def safe_source_name(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", U.safe_source_name("text").alias("name"))


@query("u10_crawl_run_id_v5", """with d as (select event_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') ||
  encode(concat('airflow://', event_type, '/manual__', event_id))) as h from events)
  select event_id, concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-5', substr(h, 14, 3), '-',
    substr('89ab', cast((instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1 as bigint), 1), substr(h, 18, 3), '-', substr(h, 21, 12)) as run_id from d""")
def run_id(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", I.stable_run_id(F.col("event_type"), F.concat(F.lit("manual__"), F.col("event_id"))).alias("run_id"))


@query("u11_object_keys", """with k as (select event_id, concat('https://example.com/', user_id) as u, ts from events),
  n as (select event_id, concat(strftime(ts + interval 7 hour, '%Y/%m/%d'), '/', substr(sha256(u), 1, 16), '_', strftime(ts, '%H%M%S_%f')) as name from k)
  select event_id, concat('crawl_data/raw/my_site/', name, '.html.gz') as raw_key, concat('crawl_data/metadata/my_site/', name, '.json') as metadata_key from n""")
def object_keys(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("https://example.com/"), F.col("user_id")).alias("url"), F.col("ts").cast("timestamp").alias("fetched_at"))
    site, zone = F.lit("my site"), "Asia/Ho_Chi_Minh"
    return e.select("event_id", I.raw_object_key(site, "url", "fetched_at", zone).alias("raw_key"),
                    I.metadata_object_key(site, "url", "fetched_at", zone).alias("metadata_key"))


@query("u12_content_hash", "select page_id, sha256(html) as content_hash from pages")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.content_hash("html").alias("content_hash"))


@query("u13_safe_object_key", """select page_id, cast(kind as bigint) as kind, ok from pages,
  (values (0, true), (1, false), (2, false), (3, true), (4, false)) t(kind, ok)""")
def safe_object_key(spark, sf_dir):
    i = F.col("page_id")
    keys = F.array(F.concat(F.lit("crawl_data/raw/"), i), F.concat(F.lit("../"), i), F.concat(F.lit("a/../../"), i),
                   F.concat(F.lit("a/./b/../../"), i), F.concat(F.lit("/etc/"), i))
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(keys).alias("kind", "key")).select(
        "page_id", F.col("kind").cast("bigint").alias("kind"), U.is_safe_object_key("key").alias("ok"))


@query("u14_redact_url_password", f"""select page_id, url as plain, concat('postgresql://news:****@', {PAGE_HOST}, ':5432/db') as secret,
  concat('https://user@', {PAGE_HOST}, '/') as user_only from pages""")
def redact(spark, sf_dir):
    host = U.netloc("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", U.redact_password("url").alias("plain"),
        U.redact_password(F.concat(F.lit("postgresql://news:s3cret@"), host, F.lit(":5432/db"))).alias("secret"),
        U.redact_password(F.concat(F.lit("https://user@"), host, F.lit("/"))).alias("user_only"))


@query("u15_parse_url_list", f"""with b as (select page_id, {PAGE_BASE} as base, regexp_extract({PAGE_BASE}, '^[a-z]+://[^/]*(.*)$', 1) as path from pages)
  select page_id, cast(0 as bigint) as entry_pos, true as accepted, case when path = '' then concat(base, '/') else base end as url from b
  union all select page_id, 3, true, concat(base, '?page=', page_id) from b
  union all select page_id, 4, false, concat('not-a-url-', page_id) from b""")
def url_list(spark, sf_dir):
    base = page_base()
    lists = table(spark, sf_dir, "pages").select("page_id", F.concat_ws(
        ",", base, F.lit("  "), F.concat(base, F.lit("?utm_source=a#b")), F.concat(F.lit(" "), base, F.lit("?page="), "page_id"),
        F.concat(F.lit(" not-a-url-"), "page_id", F.lit(" "))).alias("urls"))
    good, bad = parse_url_list(lists, "page_id", "urls")
    shape = ["page_id", F.col("entry_pos").cast("bigint").alias("entry_pos")]
    return good.select(*shape, F.lit(True).alias("accepted"), "url").unionByName(
        bad.select(*shape, F.lit(False).alias("accepted"), F.col("raw_url").alias("url")))


@query("t1_clean_text", f"select doc_id, {clean_sql('text')} as text from documents")
def clean_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.clean_text("text").alias("text"))


@query("t2_word_count", f"select doc_id, cast(coalesce(len(string_split({clean_sql('text')}, ' ')), 0) as bigint) as words from documents")
def word_count(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.word_count("text").alias("words"))


_TAGS = r"""</?[A-Za-z!?]("[^"]*"|''[^'']*''|[^>"''])*>"""


@query("t3_strip_html", f"""with c as (select page_id, regexp_replace(html, '(?is)<script[^>]*>.*?</script\\s*>|<style[^>]*>.*?</style\\s*>|<!--.*?-->', ' ', 'g') as x from pages)
  select page_id, {clean_sql(f"replace(replace(replace(replace(replace(replace(regexp_replace(x, '{_TAGS}', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&copy;', '©'), '&middot;', '·'), '&quot;', chr(34)), '&amp;', '&')")} as text from c""")
def strip_html(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", T.strip_html("html").alias("text"))


@query("t4_parse_published_at", """select event_id, cast(kind as bigint) as kind, strftime(case kind when 0 then ts when 1 then date_trunc('second', ts)
    else date_trunc('minute', ts) end, '%Y-%m-%d %H:%M:%S.%f') as published from events, (values (0), (1), (2)) t(kind)""")
def parse_published(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    ahead = F.from_utc_timestamp(ts, "Asia/Ho_Chi_Minh")
    texts = F.array(
        F.concat(F.date_format(ahead, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(" +07:00")),
        F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")),
        F.concat(F.lit("Thứ năm, "), F.date_format(ahead, "d/M/yyyy, HH:mm"), F.lit(" (GMT+7)")))
    return table(spark, sf_dir, "events").select("event_id", F.posexplode(texts).alias("kind", "t")).select(
        "event_id", F.col("kind").cast("bigint").alias("kind"),
        F.date_format(T.parse_published_at("t"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("published"))


@query("t5_content_length", "select doc_id, length(text) as chars from documents")
def content_length(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.content_length("text").alias("chars"))


@query("t6_iso_timestamp", """select event_id, replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00'), '.000000', '') as exact,
  strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') as whole from events""")
def iso_timestamp(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", T.iso_timestamp("ts").alias("exact"), T.iso_timestamp(F.date_trunc("second", "ts")).alias("whole"))


@query("t7_error_text_default", """select event_id, case when event_type = 'error' then 'Không rõ nguyên nhân' else event_type end as reason,
  case when event_type = 'view' then 'N/A' else event_type end as author from events""")
def text_default(spark, sf_dir):
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id", T.text_or(F.when(kind != "error", kind), T.NO_REASON).alias("reason"),
        T.text_or(F.when(kind == "view", F.lit("")).otherwise(kind), T.NO_AUTHOR).alias("author"))


@query("d2a_nested_get", """select event_id, cast(json_extract(props, '$.k') as varchar) as deep, cast(null as varchar) as missing, cast(null as varchar) as through_text from events""")
def nested_get(spark, sf_dir):
    doc = F.parse_json(F.concat(F.lit('{"a":{"b":'), F.col("props"), F.lit("}}")))
    e = table(spark, sf_dir, "events").select("event_id", doc.alias("doc"))

    def read(path):
        return F.try_variant_get(T.nested_get(F.col("doc"), path), "$", "string")

    return e.select("event_id", read("a.b.k").alias("deep"), read("a.x.k").alias("missing"), read("a.b.k.z").alias("through_text"))
