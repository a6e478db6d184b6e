"""Discovery on written feeds, API answers and listing pages."""

import json

import pytest
from pyspark.sql import functions as F

from pressroom.operators import discover
from pressroom.schemas import API_ATTEMPTS, FEED_PAYLOADS, LISTING_PAGES, SOURCES
from pressroom.sources.config import SOURCE_CONFIGS, builtin_sources, small_table

RSS = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:media="http://search.yahoo.com/mrss/" xmlns:content="http://purl.org/rss/1.0/modules/content/">
<channel><title>feed</title>
<item><title> One  &amp; two </title><link>https://e.com/1?utm_source=rss</link><guid isPermaLink="false">g1</guid>
 <pubDate>Wed, 02 Oct 2002 13:00:00 +0700</pubDate><dc:creator> Bob </dc:creator>
 <description><![CDATA[<a href="x"><img src="y"></a> Some <b>text</b> &amp; more]]></description>
 <enclosure url="a.mp3" type="audio/mpeg"/><enclosure url="i.png" type="image/png"/></item>
<item><title>Duplicate</title><link>https://e.com/1#again</link></item>
<item><title>No link</title><guid isPermaLink="false">x</guid></item>
<item><title>Permalink only</title><guid>https://e.com/2</guid><author>ed@e.com (Ed)</author><pubDate>some day</pubDate>
 <media:content url="m1.jpg"/><media:content url="m2.jpg"/><content:encoded><![CDATA[<p>Body</p>]]></content:encoded></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title><entry><title>Atom</title><link rel="self" href="https://e.com/self"/>
<link href="https://e.com/3"/><id>a3</id><updated>2024-01-02T03:04:05Z</updated><author><name>Ann</name></author><summary>Sum</summary></entry></feed>"""
BROKEN = "<rss><channel><title>a & b</title><item><link>https://e.com/9</link></item></channel></rss>"


def feeds(spark, *payloads, status=200):
    return spark.createDataFrame([("s", i, f"f{i}", status, p) for i, p in enumerate(payloads)], FEED_PAYLOADS)


def test_rss_fields(spark):
    rows = {r.url: r for r in discover.discover_rss(feeds(spark, RSS, ATOM)).collect()}
    assert sorted(rows) == ["https://e.com/1", "https://e.com/2", "https://e.com/3"]
    one, two, three = (rows[u] for u in sorted(rows))
    assert (one.title, one.author, one.published_at, one.thumbnail_url, one.summary) == (
        "One & two", "Bob", "2002-10-02T06:00:00+00:00", "i.png", "Some text & more")
    assert json.loads(one.raw_metadata) == {"feed_url": "f0", "guid": "g1"} and list(one.position) == [0, 0]
    assert (two.title, two.author, two.published_at, two.thumbnail_url, two.summary) == ("Permalink only", "ed@e.com (Ed)", "some day", "m1.jpg", "Body")
    assert (three.author, three.published_at, three.summary, three.discovery_method) == ("Ann", "2024-01-02T03:04:05+00:00", "Sum", "rss")


def test_blocked_and_malformed_feeds(spark):
    both = feeds(spark, BROKEN).unionByName(feeds(spark, RSS, status=429).withColumn("feed_pos", F.lit(1))).unionByName(feeds(spark, ATOM).withColumn("feed_pos", F.lit(2)))
    assert [r.url for r in discover.discover_rss(both).collect()] == ["https://e.com/3"]
    assert {(r.feed_pos, r.reason) for r in discover.rejected_feeds(both).collect()} == {(0, "malformed"), (1, "blocked")}


@pytest.mark.parametrize("limit, n", [(1, 1), (2, 2), (0, 3), (None, 3)])
def test_limit_keeps_feed_order(spark, limit, n):
    got = discover.discover_rss(feeds(spark, RSS, ATOM).repartition(4), limit).orderBy("position").collect()
    assert [r.url[-1] for r in got] == ["1", "2", "3"][:n]


def attempts(spark, rows):
    return spark.createDataFrame([(s, p, a, c, d if d is None else json.dumps(d)) for s, p, a, c, d in rows], API_ATTEMPTS)


def item(n):
    return {"url": f"https://e.com/{n}"}


def api_urls(spark, rows, **options):
    sources = small_table(spark, [{"source_id": 1, "source_name": "s", "channel_type": "api", "max_pages": 1_000, **options}], SOURCES)
    return sorted(r.url[14:] for r in discover.discover_api(attempts(spark, rows), sources).collect())


def test_api_stops_at_first_bad_page(spark):
    ok = [("s", 1, 1, 200, [item(1)]), ("s", 2, 1, 200, {"results": [item(2), item(1), "text", {"url": 5}, {"link": ""}]})]
    assert api_urls(spark, ok + [("s", 3, 1, 200, []), ("s", 4, 1, 200, [item(4)])]) == ["1", "2"]
    assert api_urls(spark, ok + [("s", 4, 1, 200, [item(4)])]) == ["1", "2"]
    assert api_urls(spark, ok + [("s", 3, 1, 404, None), ("s", 4, 1, 200, [item(4)])]) == ["1", "2"]
    assert api_urls(spark, ok + [("s", 3, 1, 200, {"unknown": [item(3)]}), ("s", 4, 1, 200, [item(4)])]) == ["1", "2"]
    assert api_urls(spark, ok, max_pages=1) == ["1"]


def test_api_retries_and_breaker(spark):
    first = [("s", 1, 1, 500, None), ("s", 1, 2, 429, None), ("s", 1, 3, 200, [item(1)])]
    assert api_urls(spark, first) == ["1"]
    assert api_urls(spark, [("s", 1, 1, 429, None), ("s", 1, 2, 429, None), ("s", 1, 3, 429, None), ("s", 1, 4, 200, [item(1)])]) == []
    assert api_urls(spark, [("s", 1, 1, 500, None), ("s", 1, 2, 500, None), ("s", 1, 3, 500, None), ("s", 2, 1, 200, [item(2)])]) == []
    # Two errors, a success and two more errors are not three in a row.
    assert api_urls(spark, [("s", 1, 1, 500, None), ("s", 1, 2, 500, None), ("s", 1, 3, 200, [item(1)]),
                            ("s", 2, 1, 500, None), ("s", 2, 2, 500, None), ("s", 2, 3, 200, [item(2)])]) == ["1", "2"]


def test_api_data_path_and_mapping(spark):
    doc = {"items": [item(9)], "res": {"list": [{"id": 1, "l": {"href": "https://e.com/1"}, "user": {"name": " Ann "}, "t": "", "headline": "H", "cover_image": False, "image": "i"}]}}
    sources = small_table(spark, [{"source_id": 1, "source_name": "S", "channel_type": "api", "data_path": "res.list",
                                   "field_mapping": {"url": "l.href", "author": "user.name", "title": "t"}}], SOURCES)
    row = discover.discover_api(attempts(spark, [("s", 1, 1, 200, doc)]), sources).first()
    assert (row.url, row.author, row.title, row.thumbnail_url, row.summary) == ("https://e.com/1", "Ann", "H", "i", None)


def test_circuit_breaker_across_buckets(spark):
    """The run must carry over bucket borders, resets included, exactly as one pass over the source would count it."""
    import random

    rng = random.Random(3)
    codes = {s: [rng.choice([200, 429, 500, 503, 404]) for _ in range(60)] for s in "abc"}
    rows = [(s, i, 1, c, None) for s, cs in codes.items() for i, c in enumerate(cs)]
    got = {(r.source_name, r.page): (r.server_error_run, r.is_cut) for r in discover.api_circuit_breaker(
        attempts(spark, rows).repartition(5), bucket=F.floor(F.col("page") / 4)).collect()}
    want = {}
    for s, cs in codes.items():
        run, tripped = 0, False
        for i, c in enumerate(cs):
            run = run + 1 if c >= 500 else run if c == 429 else 0
            want[s, i] = (run, tripped)
            tripped = tripped or run >= 3
    assert got == want


def test_listing(spark):
    html = ('<a href="/tin-1.html">A title that is long enough</a><a href="tin-2.html" title=" From attribute ">short</a><a href="/tin-1.html#c">Again, long enough</a>'
            '<a>no href</a><a href="https://other.vn/3.html">Foreign site article</a><a href="/tag/x.html">Tag page article</a><a href="//m.vnexpress.net/4.html">Mobile <b>site</b> article</a>')
    listings = spark.createDataFrame([("vnexpress", 0, "https://vnexpress.net/so-hoa/", 200, html), ("vnexpress", 1, "https://vnexpress.net/x/", 500, html.replace("tin", "bad"))], LISTING_PAGES)
    got = [(r.url, r.title) for r in discover.discover_listing(listings, builtin_sources(spark)).orderBy("position").collect()]
    assert got == [("https://vnexpress.net/tin-1.html", "A title that is long enough"), ("https://vnexpress.net/so-hoa/tin-2.html", "From attribute"),
                   ("https://m.vnexpress.net/4.html", "Mobile site article")]


def test_routing_and_selection(spark):
    sources = builtin_sources(spark)
    assert {r.source_name: r.collector for r in discover.route_collector(sources).collect()} == {
        "vnexpress": "rss", "cafef": "rss", "techcrunch": "rss", "devto": "api", "vietnamnet": "listing"}
    assert discover.select_sources(sources, name=" DevTo ").count() == 1
    assert discover.select_sources(sources, channel_type="rss").count() == 3
    assert discover.select_sources(sources, everything=True).count() == len(SOURCE_CONFIGS)


def test_url_lists(spark):
    lists = spark.createDataFrame([(1, " https://EXAMPLE.com/a?id=1&utm_source=x , https://example.com/a?id=1,, not-a-url "), (2, "")], "k int, urls string")
    good, bad = discover.parse_url_list(lists, "k", "urls")
    assert [(r.k, r.url) for r in good.collect()] == [(1, "https://example.com/a?id=1")]
    assert [(r.k, r.raw_url) for r in bad.collect()] == [(1, "not-a-url")]
