"""Metadata versions, validation, flags and fetch strategy."""

import json

from pyspark.sql import functions as F

from pressroom.operators import quality

GOOD = {
    "schema_version": 2, "source": "s", "url": "https://e.com/a", "final_url": None, "title": "t", "author": None, "published_at": None, "content": "c",
    "thumbnail_url": None, "raw_object_key": "k", "raw_payload_type": "text/html", "raw_content_hash": "h", "status": "SUCCESS", "http_status": None,
    "crawl_run_id": "r", "fetched_at": "2026-08-26T00:00:00+00:00",
}


def without(*keys):
    return {k: v for k, v in GOOD.items() if k not in keys}


CASES = [
    (GOOD, 2, None, None),
    ({**GOOD, "http_status": 200, "extra": [1]}, 2, None, None),
    ({"raw_html_path": None}, 1, "Legacy metadata v1 requires allow_legacy=True", None),
    ({"crawl_status": "SUCCESS"}, 1, "Legacy metadata v1 requires allow_legacy=True", None),
    ({**GOOD, "schema_version": "2"}, None, "Metadata must declare schema_version=2", "Metadata must declare schema_version=2"),
    ({**GOOD, "schema_version": 2.0}, 2, None, None),
    (without("title", "author"), 2, "Metadata v2 is missing fields: title, author", "Metadata v2 is missing fields: title, author"),
    ({**GOOD, "source": ""}, 2, "Metadata source must be a non-empty string", "Metadata source must be a non-empty string"),
    ({**GOOD, "url": 5}, 2, "Metadata url must be a non-empty string", "Metadata url must be a non-empty string"),
    ({**GOOD, "status": None, "url": ""}, 2, "Metadata url must be a non-empty string", "Metadata url must be a non-empty string"),
    ({**GOOD, "status": None}, 2, "Metadata status must be a non-empty string", "Metadata status must be a non-empty string"),
    ({**GOOD, "fetched_at": ""}, 2, "Metadata fetched_at must be an ISO timestamp", "Metadata fetched_at must be an ISO timestamp"),
    ({**GOOD, "http_status": "200"}, 2, "Metadata http_status must be an integer or null", "Metadata http_status must be an integer or null"),
    ({}, None, "Metadata must declare schema_version=2", "Metadata must declare schema_version=2"),
]


def test_versions_and_first_error(spark):
    df = spark.createDataFrame([(i, json.dumps(c[0])) for i, c in enumerate(CASES)], "i int, json string")
    strict = quality.validate_metadata(df).orderBy("i").collect()
    lenient = quality.validate_metadata(df, allow_legacy=True).orderBy("i").collect()
    assert [(r.schema_version, r.validation_error) for r in strict] == [(c[1], c[2]) for c in CASES]
    assert [r.validation_error for r in lenient] == [c[3] for c in CASES]


def test_unreadable_documents_are_invalid_not_fatal(spark):
    df = spark.createDataFrame([("{broken",), (None,), ("[1]",)], "json string")
    assert [r.validation_error for r in quality.validate_metadata(df).collect()] == ["Metadata must declare schema_version=2"] * 3


def test_both_generations_read_alike(spark):
    old = {"source": "s", "raw_html_path": "p", "crawl_status": "TIMEOUT", "error": "boom", "http_status": 503}
    df = spark.createDataFrame([(0, json.dumps(old)), (1, json.dumps({**GOOD, "raw_object_key": ""}))], "i int, json string")
    a, b = quality.compatible_view(df).orderBy("i").collect()
    assert (a.raw_object_key, a.status, a.error_message, a.http_status, a.schema_version) == ("p", "TIMEOUT", "boom", 503, 1)
    assert (b.raw_object_key, b.status, b.schema_version) == (None, "SUCCESS", 2)


def test_flag_order(spark):
    df = spark.createDataFrame([("", None, "", ""), ("t", "a", "p", "x" * 149), ("t", "a", "p", "x" * 150)],
                               "title string, author string, published_at string, content string")
    assert [r.f for r in df.select(quality.quality_flags().alias("f")).collect()] == [
        ["missing_title", "missing_author", "missing_published_at", "missing_content"], ["short_content"], []]


def test_browser_copy_is_used_only_when_needed(spark):
    plain = spark.createDataFrame(
        [("u1", "ok", None, 200, "http"), ("u2", " ", None, 200, "http"), ("u3", "denied", "f3", 403, "http"), ("u4", "", None, 200, "selenium"), ("u5", None, None, None, "http")],
        "url string, html string, final_url string, http_status int, fetcher_type string")
    copies = spark.createDataFrame([("u1", "copy1", "c1"), ("u2", "copy2", "c2"), ("u3", "copy3", None), ("u4", "copy4", "c4"), ("u5", " ", "c5")], "url string, html string, final_url string")
    got = {r.url: (r.html, r.final_url, r.http_status, r.fetch_method) for r in quality.fetch_strategy(plain, copies).collect()}
    assert got == {"u1": ("ok", "u1", 200, "http"), "u2": ("copy2", "c2", 200, "browser"), "u3": ("copy3", "f3", 403, "browser"),
                   "u4": ("", "u4", 200, "http"), "u5": (None, "u5", None, "http")}


def test_blank_is_unicode_aware(values):
    assert values(lambda c: quality.is_blank(F.col(c)), ["  \n", "x", "", None]) == [True, False, True, True]
