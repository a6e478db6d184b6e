"""Inputs far from the usual size: nothing crashes, nothing is cut, nothing depends on a length."""

import pytest
from pyspark.sql import functions as F

from pressroom.functions import text, urls
from pressroom.operators import discover, extract, ingest, quality, reconcile
from pressroom.operators.dom import parse_page
from pressroom.streaming.jobs import append_new_urls

MEGA = 1_000_000


def test_strip_html_long_tags_and_open_ends(values):
    cases = {
        f'<a data-x="{"y" * MEGA}">t</a>': "t",
        "<a " + " ".join(f'k{i}="v"' for i in range(100_000)) + ">t</a>": "t",
        "if a <b then " + "c " * (MEGA // 2): "if a <b then " + " ".join(["c"] * (MEGA // 2)),
        "<" * 100_000 + "x": "<" * 100_000 + "x",
        '<a x="open>' + "z" * MEGA: '<a x="open>' + "z" * MEGA,
    }
    assert values(text.strip_html, list(cases)) == list(cases.values())


def test_entities_of_every_kind(values):
    cases = {
        "Vi&ecirc;n b&agrave;i &#x00000041;": "Viên bài A", "&#38;lt; &amp;amp;": "&lt; &amp;", "&unknown; &#99999999999999999999; &NotEqualTilde;": "&unknown; � ≂̸",
        "&hellip;" * 10_000: "…" * 10_000,
    }
    assert values(text.strip_html, list(cases)) == list(cases.values())


def test_url_with_100000_parameters(values):
    query = "&".join(f"a{i}={i}" for i in range(100_000))
    url = f"https://e.com/x?{query}"
    assert values(urls.normalize_v1, [url + "&utm_source=f"]) == [url]
    assert values(urls.normalize_v2, [url + "&utm_source=f"])[0].startswith("https://e.com/x?")
    assert values(urls.normalize_v1, [url + "&b=%C3%A9"]) == [url + "&b=%C3%A9"]


@pytest.mark.parametrize("body, expected", [
    ("<div><p>Twenty characters it</p></div>", "Twenty characters it"),
    ("<div><p>x</p></div>", "x"),
    ("<div>" + "<div>word</div>" * 20_000 + "</div>", " ".join(["word"] * 20_000)),
    ("<div>" + "word " * (MEGA // 5) + "</div>", " ".join(["word"] * (MEGA // 5))),
    ("<div>" * 500 + "deep" + "</div>" * 500, "deep"),
])
def test_main_text_of_any_length(spark, body, expected):
    html = f"<html><body><nav><a href='/'>Home and more</a></nav>{body}</body></html>"
    df = spark.createDataFrame([(html,)], "html string").withColumn("page", parse_page("html"))
    assert df.select(extract.main_text(F.col("page")).alias("t")).first().t == expected


def test_first_stream_batch_without_urls(spark, tmp_path):
    table, schema = str(tmp_path / "urls"), "source_name string, url string"
    append_new_urls(spark.createDataFrame([], schema), 0, table)
    append_new_urls(spark.createDataFrame([("s", "https://e.com/1")], schema), 1, table)
    append_new_urls(spark.createDataFrame([("s", "https://e.com/1"), ("s", "https://e.com/2")], schema), 2, table)
    assert sorted(r.url for r in spark.read.schema("url string").parquet(table).collect()) == ["https://e.com/1", "https://e.com/2"]


def test_json_text_goes_by_type(spark):
    cases = ['"0"', '"false"', '"[]"', '"{}"', '""', "0", "0.00", "false", "[]", "{}", "null", "7", '"x"']
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, j string").repartition(2)
    got = [r.x for r in df.select("i", text.json_text(F.parse_json("j")).alias("x")).orderBy("i").collect()]
    assert got == ["0", "false", "[]", "{}", None, None, None, None, None, None, None, "7", "x"]


def test_api_source_without_page_count_has_one_page(spark):
    attempts = spark.createDataFrame([("s", p, 1, 200, f'[{{"url":"https://e.com/{p}","title":"0"}}]') for p in (1, 2)],
                                     "source_name string, page int, attempt int, http_status int, payload string")
    sources = spark.createDataFrame([("s", None, None, None)], "source_name string, data_path string, field_mapping map<string,string>, max_pages int")
    found = discover.discover_api(attempts, sources).collect()
    assert [(r.url, r.title) for r in found] == [("https://e.com/1", "0")]


def test_unnormalised_keys_find_their_objects(spark, values):
    assert values(urls.normalized_object_key, ["raw/./s//1.html.gz", "a/../b", "a/b/../../c", "x"]) == ["raw/s/1.html.gz", "b", "c", "x"]
    metadata = spark.createDataFrame([], "metadata_path string, readable boolean, schema_version int, raw_object_key string, raw_content_hash string")
    rows = spark.createDataFrame([(1, "raw/./s//1.html.gz", "wrong")], "id bigint, raw_object_key string, raw_content_hash string")
    files = spark.createDataFrame([("raw/s/1.html.gz", "right")], "raw_object_key string, content_hash string")
    assert reconcile.rows_without_raw(metadata, rows, files).count() == 0
    assert reconcile.hash_mismatches(metadata, rows, files).count() == 1


def test_browser_copies_do_not_multiply_pages(spark):
    plain = spark.createDataFrame([("u", "", 200, "http", "u"), ("v", "<p>x</p>", 200, "http", "v")], "url string, html string, http_status int, fetcher_type string, final_url string")
    copies = spark.createDataFrame([("u", "<p>b</p>", "f"), ("u", "<p>b</p>", "f"), ("u", "", "f"), ("v", "<p>c</p>", "g")], "url string, html string, final_url string")
    got = sorted((r.url, r.html, r.fetch_method) for r in quality.fetch_strategy(plain, copies).collect())
    assert got == [("u", "<p>b</p>", "browser"), ("v", "<p>x</p>", "http")]


def test_hints_do_not_multiply_articles(spark):
    articles = spark.createDataFrame([("u", None, None, None, None)], "url string, title string, author string, published_at string, thumbnail_url string")
    hints = spark.createDataFrame([("u", "T", None, None, None), ("u", "T", "A", None, None)], articles.schema)
    assert [(r.title, r.author) for r in extract.merge_discovery(articles, hints).collect()] == [("T", "A")]


def test_validation_does_not_depend_on_length(spark):
    long = "A long piece of news about other things. " * 100
    rows = [("Captcha", long), ("News", long + "captcha"), ("News", "captcha " * 300), ("News", long)]
    df = spark.createDataFrame([(f"https://e.com/a/{i}", t, c, 3) for i, (t, c) in enumerate(rows)], "url string, title string, content string, paragraph_count int")
    got = {r.url[-1]: list(r.validation_errors) for r in ingest.article_validation(df).collect()}
    assert got == {"0": ["captcha"], "1": [], "2": ["captcha"], "3": []}


def test_status_distribution_is_whole(spark):
    df = spark.createDataFrame([(1, s) for s in (200, 301, 404, None, None, 500)], "source_id int, http_status int")
    got = {r.http_status: r.attempts for r in ingest.status_distribution(df).collect()}
    assert got == {200: 1, 301: 1, 404: 1, None: 2, 500: 1}
