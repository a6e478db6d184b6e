"""Discovery from feeds, API answers and listing pages, all derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressroom.functions import urls as U
from pressroom.operators import discover
from pressroom.schemas import SOURCES
from pressroom.sources.config import small_table
from suite import query
from suite.views import LOG, PAGE_HOST, clean_sql, crawl_log, documents, pages, table

ITEMS_PER_FEED = 50


def _xml(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _feeds(spark, sf_dir):
    """Every document stands in two consecutive feeds of its source, the second time with a tracking parameter.

    A feed holds the documents of 50 consecutive ids at most. One feed in ten is blocked.
    """
    d = documents(spark, sf_dir).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    i = F.col("doc_id")
    feed = (F.floor(i / ITEMS_PER_FEED) + F.col("copy")).cast("int")
    link = F.concat(F.lit("https://news.example.com/"), i, F.when(F.col("copy") == 1, "?utm_source=rss").otherwise("#top"))
    markup = F.concat(F.lit("<p>"), _xml(F.col("text")), F.lit("</p>"))
    day = F.date_format(F.timestamp_seconds(F.lit(1704067200) + i * 60), "EEE, dd MMM yyyy HH:mm:ss")
    item = F.concat(
        F.lit("<item><title>Doc &amp; "), i, F.lit("</title><link>"), link, F.lit('</link><guid isPermaLink="false">g'), i, F.lit("</guid>"),
        F.when(i % 3 == 0, F.concat(F.lit("<author> A  "), i, F.lit("</author>"))).otherwise(F.concat(F.lit("<dc:creator>C "), i, F.lit("</dc:creator>"))),
        F.when(i % 4 == 0, F.concat(F.lit("<pubDate>soon "), i, F.lit("</pubDate>"))).otherwise(F.concat(F.lit("<pubDate>"), day, F.lit(" +0000</pubDate>"))),
        F.when(i % 5 == 0, F.concat(F.lit('<media:content url="m'), i, F.lit('"/>')))
        .otherwise(F.concat(F.lit('<enclosure url="a" type="audio/mp3"/><enclosure url="e'), i, F.lit('" type="image/png"/>'))),
        F.lit("<description>"), _xml(markup), F.lit("</description></item>"))
    head = '<rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:media="http://search.yahoo.com/mrss/"><channel><title>t</title>'
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("doc_id", item.alias("x")))), lambda s: s["x"]), "")
    return d.withColumn("feed_pos", feed).groupBy(F.col("source").alias("source_name"), "feed_pos").agg(
        F.concat(F.lit(head), body, F.lit("<item><title>no link</title></item></channel></rss>")).alias("payload")
    ).select("source_name", "feed_pos", F.concat(F.lit("https://news.example.com/feed/"), "feed_pos").alias("feed_url"),
             F.when(F.col("feed_pos") % 10 == 9, 403).otherwise(200).alias("http_status"), "payload")


_RSS = f"""o as (select source as source_name, doc_id, cast(doc_id // 50 + copy as bigint) as feed_pos, text,
    concat('https://news.example.com/', doc_id) as url from documents, (values (0), (1)) t(copy)),
  f as (select *, row_number() over (partition by source_name, feed_pos order by doc_id) - 1 as item_pos from o),
  p as (select *, row_number() over (partition by source_name, url order by feed_pos, item_pos) as rn from f where feed_pos % 10 <> 9),
  q as (select *, row_number() over (partition by source_name order by feed_pos, item_pos) as nr from p where rn = 1)
  select source_name, url, concat('Doc & ', doc_id) as title, concat(case when doc_id % 3 = 0 then 'A ' else 'C ' end, doc_id) as author,
    case when doc_id % 4 = 0 then concat('soon ', doc_id) else strftime(to_timestamp(1704067200 + doc_id * 60) at time zone 'UTC', '%Y-%m-%dT%H:%M:%S+00:00') end as published_at,
    concat(case when doc_id % 5 = 0 then 'm' else 'e' end, doc_id) as thumbnail_url, {clean_sql('text')} as summary,
    concat('{{"feed_url":"https://news.example.com/feed/', feed_pos, '","guid":"g', doc_id, '"}}') as raw_metadata from q"""
_RSS_COLUMNS = ["source_name", "url", "title", "author", "published_at", "thumbnail_url", "summary", "raw_metadata"]


@query("d1_discover_rss", f"with {_RSS}")
def discover_rss(spark, sf_dir):
    return discover.discover_rss(_feeds(spark, sf_dir)).select(*_RSS_COLUMNS)


@query("d1_discover_rss_limit", f"with {_RSS} where nr <= 7")
def discover_rss_limit(spark, sf_dir):
    return discover.discover_rss(_feeds(spark, sf_dir), limit=7).select(*_RSS_COLUMNS)


@query("d1_rejected_feeds", """with f as (select distinct source as source_name, cast(doc_id // 50 + copy as integer) as feed_pos from documents, (values (0), (1)) t(copy))
  select source_name, feed_pos, case when feed_pos % 10 = 9 then 'blocked' else 'malformed' end as reason from f where feed_pos % 10 in (4, 9)""")
def rejected_feeds(spark, sf_dir):
    """One feed in ten carries a bare ampersand, which is no XML."""
    broken = F.when(F.col("feed_pos") % 10 == 4, F.replace("payload", F.lit("<title>t</title>"), F.lit("<title>a & b</title>"))).otherwise(F.col("payload"))
    return discover.rejected_feeds(_feeds(spark, sf_dir).withColumn("payload", broken)).select("source_name", "feed_pos", "reason")


@query("d1a_rss_published_at", """select event_id, case event_type when 'view' then concat('on ', event_id) when 'click' then null
  else strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') end as published_at from events""")
def rss_published_at(spark, sf_dir):
    kind = F.col("event_type")
    stamp = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    e = table(spark, sf_dir, "events").select(
        "event_id", F.when(kind == "view", F.concat(F.lit(" on  "), "event_id")).when(kind.isin("error", "signup"), stamp).alias("p"),
        F.when(~kind.isin("view", "click"), stamp).alias("u"))
    return e.select("event_id", discover.rss_published_at(F.col("p"), F.col("u")).alias("published_at"))


@query("d1b_rss_author", """select event_id, case when event_type = 'view' then concat('U ', user_id) else event_type end as author from events""")
def rss_author(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", discover.rss_author(F.when(F.col("event_type") == "view", " ").otherwise(F.col("event_type")),
                                                    F.concat(F.lit("U  "), "user_id")).alias("author"))


@query("d1c_rss_thumbnail", """select event_id, case event_type when 'view' then 'c' when 'click' then 't' when 'error' then concat('e', user_id) end as thumbnail from events""")
def rss_thumbnail(spark, sf_dir):
    kind = F.col("event_type")
    shapes = F.array(F.struct(F.lit("a").alias("url"), F.lit("audio/mp3").alias("type")), F.struct(F.lit("").alias("url"), F.lit("image/gif").alias("type")),
                     F.struct(F.concat(F.lit("e"), "user_id").alias("url"), F.lit("image/png").alias("type")))
    return table(spark, sf_dir, "events").select("event_id", discover.rss_thumbnail(
        F.when(kind == "view", F.array(F.lit("c"), F.lit("d"))), F.when(kind == "click", F.array(F.lit(" t "))),
        F.when(kind == "error", shapes)).alias("thumbnail"))


@query("d1d_rss_summary", f"select doc_id, {clean_sql('text')} as summary from documents")
def rss_summary(spark, sf_dir):
    markup = F.concat(F.lit('<img src="x>y"/><p>'), _xml(F.col("text")), F.lit("</p><br>"))
    d = documents(spark, sf_dir).select("doc_id", markup.alias("m"))
    return d.select("doc_id", discover.rss_summary(F.when(F.col("doc_id") % 2 == 0, F.col("m")).otherwise(""), F.col("m")).alias("summary"))


def _api_sources(spark):
    mapping = {"url": "link.href", "author": "user.name", "title": "t"}
    return small_table(spark, [
        {"source_id": 1, "source_name": "api0", "channel_type": "api", "data_path": "res.list", "field_mapping": mapping, "max_pages": 1_000_000_000},
        {"source_id": 2, "source_name": "api1", "channel_type": "api", "data_path": "", "max_pages": 1_000_000_000},
        {"source_id": 3, "source_name": "api2", "channel_type": "api", "max_pages": 1_000_000_000},
        {"source_id": 4, "source_name": "api3", "channel_type": "api", "max_pages": 1_000_000_000},
    ], SOURCES)


def _api_attempts(spark, sf_dir):
    """Four sources with the documents as items, 20 to a page at most. ``api1`` needs retries on page 2, ``api2``
    fails on page 3, ``api3`` has an empty page 3, and the items of ``api0`` lie under a path."""
    d = documents(spark, sf_dir)
    i = F.col("doc_id")
    plain = F.to_json(F.struct(
        F.when(i % 2 == 0, F.concat(F.lit("https://api.example.com/"), i)).alias("url"), F.concat(F.lit("https://api.example.com/"), i, F.lit("?gclid=1")).alias("link"),
        F.when(i % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("T "), i)).alias("title"), F.concat(F.lit("H "), i).alias("headline"),
        F.col("lang").alias("author"), F.col("text").alias("description"), F.lit(0).alias("cover_image"), F.concat(F.lit("img"), i).alias("image")))
    nested = F.to_json(F.struct(
        F.struct(F.concat(F.lit("https://api.example.com/"), i).alias("href")).alias("link"), F.concat(F.lit("T "), i).alias("t"),
        F.struct(F.col("lang").alias("name")).alias("user"), F.col("text").alias("description"), F.concat(F.lit("img"), i).alias("cover_image")))
    source = F.concat(F.lit("api"), i % 4)
    page = (F.floor(i / 80) + 1).cast("int")
    items = d.select(source.alias("source_name"), page.alias("page"), i, F.when(i % 4 == 0, nested).otherwise(plain).alias("x"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("doc_id", "x"))), lambda s: s["x"]), ",")
    per_page = items.groupBy("source_name", "page").agg(joined.alias("x"))
    name, p = F.col("source_name"), F.col("page")
    payload = (
        F.when(name == "api0", F.concat(F.lit('{"items":[{"url":"https://no"}],"res":{"list":["text",'), "x", F.lit("]}}")))
        .when((name == "api3") & (p == 3), F.lit('{"articles":[]}'))
        .when(p % 2 == 0, F.concat(F.lit("["), "x", F.lit(",17]"))).otherwise(F.concat(F.lit('{"total":1,"posts":['), "x", F.lit("]}"))))
    codes = (F.when((name == "api1") & (p == 2), F.array(F.lit(503), F.lit(429), F.lit(200)))
             .when((name == "api2") & (p == 3), F.array(F.lit(500), F.lit(404))).otherwise(F.array(F.lit(200))))
    return per_page.select("source_name", "page", payload.alias("payload"), F.posexplode(codes).alias("attempt0", "http_status")).select(
        "source_name", "page", (F.col("attempt0") + 1).alias("attempt"), "http_status",
        F.when(F.col("http_status") == 200, F.col("payload")).alias("payload"))


@query("d2_discover_api", f"""with d as (select *, doc_id % 4 as s, doc_id // 80 + 1 as page from documents)
  select concat('api', s) as source_name, concat('https://api.example.com/', doc_id) as url,
    case when s = 0 or doc_id % 3 <> 0 then concat('T ', doc_id) else concat('H ', doc_id) end as title, lang as author, {clean_sql('text')} as summary,
    concat('img', doc_id) as thumbnail_url, cast(null as varchar) as published_at from d where s < 2 or page < 3""")
def discover_api(spark, sf_dir):
    found = discover.discover_api(_api_attempts(spark, sf_dir), _api_sources(spark))
    return found.select("source_name", "url", "title", "author", "summary", "thumbnail_url", "published_at")


@query("d2_discover_api_limit", """with d as (select *, doc_id % 4 as s, doc_id // 80 + 1 as page from documents),
  r as (select *, row_number() over (partition by s order by doc_id) as nr from d where s < 2 or page < 3)
  select concat('api', s) as source_name, concat('https://api.example.com/', doc_id) as url from r where nr <= 25""")
def discover_api_limit(spark, sf_dir):
    return discover.discover_api(_api_attempts(spark, sf_dir), _api_sources(spark), limit=25).select("source_name", "url")


@query("d2b_api_alias_chain", """select event_id, case event_type when 'view' then event_type when 'click' then concat('H', user_id) end as title,
  case when event_type = 'view' then 'd' when event_type = 'click' then concat('s', user_id) else concat('d', user_id) end as summary from events""")
def api_alias_chain(spark, sf_dir):
    """Mapped path, then aliases; empty text, zero, false and empty lists fall through."""
    kind, u = F.col("event_type"), F.col("user_id").cast("string")
    doc = F.when(kind == "view", F.concat(F.lit('{"title":"view","headline":"h","description":"d"}'))).when(
        kind == "click", F.concat(F.lit('{"title":"","headline":"H'), u, F.lit('","description":0,"summary":"s'), u, F.lit('"}'))).otherwise(
        F.concat(F.lit('{"title":[],"headline":false,"summary":{},"description":"d'), u, F.lit('"}')))
    no_mapping = F.create_map(F.lit("x"), F.lit("y"))
    return table(spark, sf_dir, "events").select("event_id", F.try_parse_json(doc).alias("i")).select(
        "event_id", discover.api_field(F.col("i"), no_mapping, "title").alias("title"), discover.api_field(F.col("i"), no_mapping, "summary").alias("summary"))


@query("d2c_api_outcome_classify", f"""with {LOG} select id, case http_status when 503 then 'retry_server_error' when 429 then 'retry_rate_limit'
  else case when id % 10 = 0 then 'stop' else 'parse' end end as outcome from log""")
def outcome_classify(spark, sf_dir):
    log = crawl_log(spark, sf_dir)
    code = F.when((F.col("http_status") == 200) & (F.col("id") % 10 == 0), 404).otherwise(F.col("http_status"))
    return log.select("id", discover.classify_attempt(code).alias("outcome"))


@query("d2d_api_circuit_breaker", f"""with {LOG}, c as (select *, sum(case when http_status not in (503, 429) then 1 else 0 end) over w as island from log
    window w as (partition by source_id order by fetched_at, id)),
  r as (select *, sum(case when http_status = 503 then 1 else 0 end) over (partition by source_id, island order by fetched_at, id) as run from c),
  t as (select source_id, min((fetched_at, id)) as cut from r where run >= 3 group by source_id)
  select id, r.source_id, cast(run as bigint) as server_error_run, coalesce((fetched_at, id) > cut, false) as is_cut from r left join t using (source_id)""")
def circuit_breaker(spark, sf_dir):
    log = crawl_log(spark, sf_dir).select("id", "source_id", "http_status", "fetched_at")
    out = discover.api_circuit_breaker(log, "source_id", ["fetched_at", "id"], F.date_trunc("hour", F.col("fetched_at")))
    return out.select("id", "source_id", "server_error_run", "is_cut")


def _listing_sources(spark):
    return small_table(spark, [{"source_id": i, "source_name": s, "channel_type": "html", "domains": [f"example.{s}"]}
                               for i, s in enumerate(["com", "net", "org"])], SOURCES)


def _listings(spark, sf_dir):
    """Pages as listing pages: their own links plus a few planted ones."""
    i = F.col("page_id")
    planted = F.concat(
        F.lit('<a href="../../../story/'), i, F.lit('.html?utm_source=x#c">A long enough title '), i, F.lit('</a><a href="/s/'), i,
        F.lit('9" title=" Titled '), i, F.lit('">short</a><a href="https://other.test/1.html">foreign site</a><a href="/tag/9.html">tag page nine</a><footer>'))
    p = pages(spark, sf_dir)
    return p.select(F.regexp_extract(U.netloc("url"), r"\.([a-z]+)$", 1).alias("source_name"), i.alias("listing_pos"), F.col("url").alias("listing_url"),
                    F.when(i % 50 == 7, 503).otherwise(200).alias("http_status"), F.replace("html", F.lit("<footer>"), planted).alias("html"))


_LISTED = f"""p as (select page_id, {PAGE_HOST} as host, regexp_extract(url, '^[a-z]+://[^/?#]*') as origin, html from pages where page_id % 50 <> 7),
  own as (select page_id, host, origin, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as href,
    unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) as label, unnest(range(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)))) as pos from p),
  planted as (select page_id, host, origin, concat('/story/', page_id, '.html') as href, concat('A long enough title ', page_id) as label, 100000 as pos from p
    union all select page_id, host, origin, concat('/s/', page_id, '9'), concat('Titled ', page_id), 100001 from p),
  l as (select page_id, host, origin, href, case when length(label) >= 10 then label end as title, pos from own
    where regexp_matches(href, '[0-9]') or length(trim(href, '/')) > 30 or href like '%.html'
    union all select * from planted),
  r as (select *, row_number() over (partition by regexp_extract(host, '[a-z]+$'), concat(origin, href) order by page_id, pos) as rn from l),
  u as (select *, regexp_extract(host, '[a-z]+$') as source_name, concat(origin, href) as url from r where rn = 1)"""


@query("d3_discover_listing", f"with {_LISTED} select source_name, url, title from u")
def discover_listing(spark, sf_dir):
    return discover.discover_listing(_listings(spark, sf_dir), _listing_sources(spark)).select("source_name", "url", "title")


@query("d3_discover_listing_limit", f"""with {_LISTED}, n as (select *, row_number() over (partition by source_name order by page_id, pos) as nr from u)
  select source_name, url, title from n where nr <= 10""")
def discover_listing_limit(spark, sf_dir):
    return discover.discover_listing(_listings(spark, sf_dir), _listing_sources(spark), limit=10).select("source_name", "url", "title")


@query("d4_discover_homepage", f"""with p as (select page_id, {PAGE_HOST} as host, regexp_extract(url, '^[a-z]+://[^/?#]*') as origin from pages)
  select concat('s', page_id) as source_name, concat(origin, '/story/', page_id, '.html') as url from p where host like '%.example.com'
  union all select concat('s', page_id), concat(origin, '/tag/9.html') from p where host like '%.example.com'""")
def discover_homepage(spark, sf_dir):
    home = _listings(spark, sf_dir).select(F.concat(F.lit("s"), "listing_pos").alias("source_name"), F.col("listing_url").alias("home_url"), "html")
    return discover.discover_homepage(home, "example.com").select("source_name", "url")


def _derived_sources(spark, sf_dir):
    i = F.col("page_id")
    none = F.lit(None).cast("array<string>")
    kind = F.when(i % 3 == 0, "rss").when(i % 3 == 1, "api").otherwise("html")
    return table(spark, sf_dir, "pages").select(
        i.alias("source_id"), F.concat(F.lit("Site"), i).alias("source_name"), kind.alias("channel_type"),
        F.when(i % 5 == 0, F.array("url")).otherwise(none).alias("rss_feeds"), F.when(i % 7 == 0, F.col("url")).alias("api_url"))


@query("d5_route_collector", """select page_id as source_id, case when page_id % 3 = 0 or page_id % 5 = 0 then 'rss'
  when page_id % 3 = 1 or page_id % 7 = 0 then 'api' else 'listing' end as collector from pages""")
def route_collector(spark, sf_dir):
    return discover.route_collector(_derived_sources(spark, sf_dir)).select("source_id", "collector")


@query("d6_select_sources", """select page_id as source_id, 'type' as choice from pages where page_id % 3 = 1 union all select page_id, 'name' from pages where page_id = 7
  union all select page_id, 'all' from pages""")
def select_sources(spark, sf_dir):
    s = _derived_sources(spark, sf_dir)

    def pick(choice, **how):
        return discover.select_sources(s, **how).select("source_id", F.lit(choice).alias("choice"))

    return pick("type", channel_type="api").unionByName(pick("name", name=" SITE7 ")).unionByName(pick("all", everything=True))


@query("d7_dry_run_listing", """with q as (select source, doc_id, text,
    row_number() over (partition by source order by doc_id) as nr from documents)
  select source as source_name, nr as line, case when doc_id % 2 = 0 then 'Không rõ ngày' else concat('day ', doc_id) end as published_at,
    case when doc_id % 3 = 0 then 'Không tiêu đề' else concat('Doc ', doc_id) end as title, concat('https://e.com/', doc_id) as url,
    concat(substr(text, 1, 120), '...') as summary from q where nr <= 5""")
def dry_run(spark, sf_dir):
    i = F.col("doc_id")
    found = documents(spark, sf_dir).select(
        F.col("source").alias("source_name"), F.when(i % 2 == 1, F.concat(F.lit("day "), i)).alias("published_at"),
        F.when(i % 3 == 0, "").otherwise(F.concat(F.lit("Doc "), i)).alias("title"), F.concat(F.lit("https://e.com/"), i).alias("url"),
        F.col("text").alias("summary"), F.array(i).alias("position"))
    return discover.dry_run_listing(found, 5)


@query("d7_dry_run_whole", """select source as source_name, row_number() over (partition by source order by doc_id) as line, concat('https://e.com/', doc_id) as url from documents""")
def dry_run_whole(spark, sf_dir):
    """Without a limit: every find has its line, counted in pieces of a source."""
    i = F.col("doc_id")
    none = F.lit(None).cast("string")
    found = documents(spark, sf_dir).select(F.col("source").alias("source_name"), none.alias("published_at"), none.alias("title"), F.concat(F.lit("https://e.com/"), i).alias("url"),
                                            none.alias("summary"), F.array(i).alias("position"))
    return discover.dry_run_listing(found, 0).select("source_name", "line", "url")
