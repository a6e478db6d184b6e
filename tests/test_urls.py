"""URL functions against fixed strings and, for generated URLs, against the Python standard library."""

import hashlib
import random
import uuid
from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit, urlunsplit

import pytest
from pyspark.sql import functions as F

from pressroom.functions import ids, urls


def expected_v1(url):
    parts = urlsplit(url.strip())
    query = [(k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True) if k.lower() not in urls.TRACKING_V1]
    return urlunsplit((parts.scheme, parts.netloc, parts.path, urlencode(query), ""))


def expected_v2(url):
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname, parts.port
    except ValueError:
        return None
    if parts.scheme not in ("http", "https") or not parts.netloc or not host:
        return None
    host = f"[{host.lower()}]" if ":" in host else host.lower()
    default = {"http": 80, "https": 443}[parts.scheme]
    netloc = host if port in (None, default) else f"{host}:{port}"
    query = [(k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True) if k.lower() not in urls.TRACKING_V2]
    return urlunsplit((parts.scheme, netloc, parts.path or "/", urlencode(query), ""))


SPECIAL = [
    "\tHttps://News.Example.ORG:443/p/7?page=2&utm_medium=mail#top ", "https://news.example.org", "https://news.example.org/world/",
    "", "news.example.org/p", "ftp://news.example.org/f", "HTTP://e.com/a?b&c=&=d&&x=1;2", "http://u:p@e.com:8080/a b?q=a*b~c+d%20é%zz",
    "http://[::1]:80/x", "http://[2001:DB8::1]:8080", "http://e.com:99999/", "http://e.com:ab/", "http://:80/", "http://e.com:/a",
    "https://e.com:080/?UTM_Source=1&a=2", "http://e.com/a?b=c=d", "//h/p", "/p?x=1", "http://e.com/a?x=1&x=2&x=1",
    " http://e.com/a ", "http://e.com/a?utm_source=1", "http://e.com/?fbclid=1&gclid=2#x", "http://e.com/a\tb", "http://user@e.com/",
    "http://e.com/p;x?a=%26&b=%3D", "https://e.com/a?q=%C3%A9&r=%2B+%20", "http://E.com/A", "http://e.com/a?_ga=1&mc_cid=2&igshid=3",
]


def generated(n=400):
    rng = random.Random(7)
    names = urls.TRACKING_V2 + ["id", "q", "Page", "a b", "é", "", "UTM_Term"]
    pieces = ["1", "", "x y", "a+b", "%20", "~*", "ü", "a%2Fb", "=", "%zz", "-._"]
    for _ in range(n):
        url = rng.choice(["http", "https", "HTTP", "Https"]) + "://" + rng.choice(["", "", "u@", "u:p@"])
        url += rng.choice(["e.com", "WWW.E.com", "a.b.c.org", "[::1]", "xn--a.vn"]) + rng.choice(["", "", ":80", ":443", ":8080", ":"])
        url += rng.choice(["", "/", "/a/b.html", "/a//b/", "/ü/x"])
        if rng.random() < 0.8:
            url += "?" + "&".join(rng.choice(names) + rng.choice(["", "=", "=" + rng.choice(pieces)]) for _ in range(rng.randint(0, 4)))
        yield url + rng.choice(["", "#", "#top"])


ALL = SPECIAL + list(generated())


def test_v1_matches_standard_library(values):
    assert values(urls.normalize_v1, ALL) == [expected_v1(u) for u in ALL]


def test_v2_matches_standard_library(values):
    assert values(urls.normalize_v2, ALL) == [expected_v2(u) for u in ALL]


def test_validity_agrees_with_v2(values):
    assert values(urls.is_valid, ALL) == [expected_v2(u) is not None for u in ALL]


def test_normalisation_is_idempotent(values):
    once = [u for u in values(urls.normalize_v2, ALL) if u]
    assert values(urls.normalize_v2, once) == once


def test_null_stays_null_or_false(values):
    assert values(urls.normalize_v1, [None]) == [None]
    assert values(urls.normalize_v2, [None]) == [None]
    assert values(urls.is_valid, [None]) == [False]


def test_hash_is_prefix_of_sha256(values):
    assert values(urls.url_hash_v1, ALL) == [hashlib.sha256(expected_v1(u).encode()).hexdigest()[:16] for u in ALL]


REFS = ["x", "./x", "../x", "../../x", "../../../x", "/y", "/y/./z/..", "//h/z", "?k=1", "#frag", "", "http://z.com/q#e", "g/", "..", ".",
        "a//b", "mailto:q@r", "y?z#w", "javascript:void(0)", "/", "./", "a/./b/../c", " x "]


@pytest.mark.parametrize("base", ["http://a.com/b/c/d.html?q=1#f", "http://a.com", "http://a.com/", "https://a.com/b/", "http://a.com/b?x=/y/z"])
def test_url_join_matches_standard_library(spark, base):
    rows = spark.createDataFrame([(base, r) for r in REFS], "b string, r string").select("r", urls.url_join("b", "r").alias("j")).collect()
    assert {r.r: r.j for r in rows} == {r: urljoin(base, r.strip()) for r in REFS}


def test_article_links(spark):
    cases = [
        ("https://vnexpress.net/a-b-123.html", True), ("https://e.vnexpress.net/a.html", True), ("https://vnexpress.net/so-hoa/123", False),
        ("https://vnexpress.net/tag/a.html", False), ("https://other.net/a.html", False), ("https://site.org/feedback-1.html", False),
        ("https://site.org/2024/x", True), ("https://site.org/short", False), ("https://site.org/" + "a" * 31, True), ("https://site.org/", False),
        ("https://site.org/data.json1", False), ("https://site.org:80/1.html", False), ("https://SITE.org/1.CHN", True),
    ]
    df = spark.createDataFrame(cases, "u string, ok boolean")
    domains = F.array(F.lit("vnexpress.net"), F.lit("Site.org"))
    got = df.select("u", "ok", urls.is_article_link("u", domains).alias("got")).collect()
    assert [r.u for r in got if r.ok != r.got] == []


def test_object_keys_stay_inside(values):
    cases = {"a/b": True, "../x": False, "a/../../x": False, "/abs": False, "a/../b": True, "": True, "a/./../..": False, None: False}
    assert values(urls.is_safe_object_key, list(cases)) == list(cases.values())


def test_names_and_redaction(values):
    assert values(urls.safe_source_name, [" my site/1 ", "ok-1_2.x", "", "đài"]) == ["my_site_1", "ok-1_2.x", "unknown", "_i"]
    assert values(urls.redact_password, ["postgresql://u:p@h:1/d", "postgresql://u@h/d", "https://h/p?x=a:b@c"]) == [
        "postgresql://u:****@h:1/d", "postgresql://u@h/d", "https://h/p?x=a:b@c"]
    assert values(urls.infer_source_name, ["https://www.news.com/x", "https://blog.a.org", "nothing"]) == ["news", "blog", "generic"]


def test_run_id_is_uuid5(spark):
    row = spark.range(1).select(ids.stable_run_id(F.lit("dag"), F.lit("manual__é")).alias("x")).first()
    assert row.x == str(uuid.uuid5(uuid.NAMESPACE_URL, "airflow://dag/manual__é"))


def test_object_key_uses_local_date_and_utc_time(spark):
    row = spark.sql("select timestamp '2026-08-30 20:01:02.000345' as t").select(
        ids.raw_object_key(F.lit("my site"), F.lit("https://e.com/a"), "t", "Asia/Ho_Chi_Minh").alias("k")).first()
    name = hashlib.sha256(b"https://e.com/a").hexdigest()[:16]
    assert row.k == f"crawl_data/raw/my_site/2026/08/31/{name}_200102_000345.html.gz"
