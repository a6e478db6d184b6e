"""Lookup, duplicates, upserts and running totals."""

import random

import pytest
from pyspark.sql import functions as F

from pressroom.operators import dedupe, ingest
from pressroom.operators.running import running
from pressroom.schemas import RAWDATA, SOURCES
from pressroom.sources.config import builtin_sources, small_table, sources_table


@pytest.mark.parametrize("in_row_domains", [1000, 0])
def test_source_by_name_then_domain_then_generic(spark, in_row_domains):
    cases = [
        ("https://vnexpress.net/a", None, "vnexpress", 1, "vnexpress"), ("https://e.vnexpress.net/a", "", "vnexpress", 1, "vnexpress"),
        ("https://notvnexpress.net/a", None, "generic", 999, "notvnexpress"), ("https://vnexpress.net/a", " CafeF ", "cafef", 2, "cafef"),
        ("https://dev.to/x", "unknown", "devto", 101, "devto"), ("https://www.news.org/x", "Mine", "generic", 999, "Mine"),
        ("https://vnexpress.net:8080/a", None, "generic", 999, "vnexpress"), ("https://VNExpress.net/a", None, "vnexpress", 1, "vnexpress"),
        (None, None, "generic", 999, "generic"),
    ]
    df = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(cases)], "i int, url string, given string")
    got = dedupe.resolve_source(df, builtin_sources(spark), named="given", in_row_domains=in_row_domains).orderBy("i").collect()
    assert [(r.rule_set, r.source_id) for r in got] == [c[2:4] for c in cases]
    assert [r.source_name for r in got][:-1] == [c[4] for c in cases][:-1]


def test_first_configured_domain_wins_and_last_owner_holds_it(spark):
    rows = [{"source_id": 1, "source_name": "wide", "domains": ["a.org", "x.org"], "config_order": 0},
            {"source_id": 2, "source_name": "narrow", "domains": ["b.a.org"], "config_order": 1},
            {"source_id": 3, "source_name": "late", "domains": ["x.org"], "config_order": 2}]
    df = spark.createDataFrame([("https://c.b.a.org/",), ("https://x.org/",)], "url string")
    got = dedupe.resolve_source(df, small_table(spark, rows, SOURCES)).collect()
    assert [r.source_name for r in got] == ["wide", "late"]


def test_later_source_config_wins(spark):
    rows = [{"source_id": 1, "source_name": "A", "channel_type": "rss", "config_order": 0}, {"source_id": 2, "source_name": "a", "channel_type": "api", "config_order": 1},
            {"source_id": 3, "source_name": "b", "channel_type": "ftp", "config_order": 2}, {"source_id": None, "source_name": "c", "channel_type": "rss", "config_order": 3}]
    good, bad = sources_table(small_table(spark, rows, SOURCES))
    assert [r.source_id for r in good.collect()] == [2] and sorted(r.source_name for r in bad.collect()) == ["b", "c"]


def test_running_totals_equal_a_single_pass(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, "a", "b"]), i, rng.randint(-3, 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, i int, v bigint").withColumn("b", F.floor(F.col("i") / 7)).repartition(6)
    got = {r.i: (r.s, r.m) for r in running(df, ["k"], ["b"], ["i"], {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}).collect()}
    sums, peaks = {}, {}
    for k, i, v in rows:
        sums[k] = sums.get(k, 0) + v
        peaks[k] = max(peaks.get(k, v), v)
        assert got[i] == (sums[k], peaks[k])


def test_order_sensitive_picks_ignore_partitioning(spark):
    rows = [(f"s{i % 3}", f"u{i % 50}", (i * 7919) % 1000) for i in range(1000)]
    df = spark.createDataFrame(rows, "source_name string, url string, pos int")
    one, many = (sorted(dedupe.dedupe_first_wins(df.repartition(n), ["pos"]).collect()) for n in (1, 8))
    assert one == many and len(one) == 150
    best = {}
    for s, u, p in rows:
        best[s, u] = min(best.get((s, u), p), p)
    assert {(r.source_name, r.url): r.pos for r in one} == best


def artifacts(spark, rows):
    return spark.createDataFrame(rows, "source_name string, url_hash string, modified_at timestamp, metadata_path string, readable boolean")


def test_skip_scope_and_unreadable_newest(spark):
    import datetime as dt

    t = [dt.datetime(2024, 1, d) for d in (1, 2)]
    stored = artifacts(spark, [("a", "h1", t[0], "p1", True), ("a", "h2", t[0], "p2", True), ("a", "h2", t[1], "p3", False), ("b", "h3", t[0], "p4", True)])
    wanted = spark.createDataFrame([("a", "h1"), ("a", "h2"), ("a", "h3"), ("new", "h3"), ("new", "h4")], "source_name string, url_hash string")
    left = {tuple(r) for r in dedupe.skip_any_artifact(wanted, stored).select("source_name", "url_hash").collect()}
    assert left == {("a", "h2"), ("a", "h3"), ("new", "h4")}
    assert dedupe.skip_any_artifact(wanted, stored, force=True).count() == 5
    assert dedupe.skip_any_artifact(wanted, artifacts(spark, [])).count() == 5


def raw(spark, rows):
    base = "select cast(null as bigint) id, '' url, cast(null as string) crawl_run_id, '' status, '' fetched_at where false"
    df = spark.createDataFrame(rows, "id bigint, url string, crawl_run_id string, status string, fetched_at string") if rows else spark.sql(base)
    return df.select(
        "id", F.lit(1).cast("bigint").alias("source_id"), "url", F.lit(None).cast("string").alias("final_url"), F.lit(200).alias("http_status"),
        *[F.lit(None).cast("string").alias(c) for c in ["raw_object_key", "raw_payload_type", "raw_content_hash"]], "crawl_run_id", "status",
        F.lit(None).cast("string").alias("error_type"), F.lit(None).cast("string").alias("error_message"),
        F.col("fetched_at").cast("timestamp").alias("fetched_at"), F.col("fetched_at").cast("timestamp").alias("created_at"))


def test_upsert_keeps_id_and_replays_cleanly(spark):
    old = raw(spark, [(7, "u", "r", "TIMEOUT", "2024-01-01"), (8, "v", "r", "SUCCESS", "2024-01-01")])
    new = raw(spark, [(None, "u", "r", "SUCCESS", "2024-01-02"), (None, "u", "r2", "SUCCESS", "2024-01-02"), (None, "v", "r", "TIMEOUT", "2023-12-31")])
    once = dedupe.assign_ids(dedupe.upsert_rawdata(old, new), 8)
    rows = {(r.url, r.crawl_run_id): (r.id, r.status, r.created_at.day) for r in once.collect()}
    assert rows == {("u", "r"): (7, "SUCCESS", 1), ("v", "r"): (8, "SUCCESS", 31), ("u", "r2"): (9, "SUCCESS", 2)}
    again = dedupe.upsert_rawdata(once, new)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.select(*again.columns).collect()))


def test_same_fetch_time_is_won_by_the_incoming_row(spark):
    old, new = raw(spark, [(1, "u", "r", "TIMEOUT", "2024-01-01")]), raw(spark, [(None, "u", "r", "SUCCESS", "2024-01-01")])
    assert dedupe.upsert_rawdata(old, new).first().status == "SUCCESS"


def test_first_payload_stays(spark):
    schema = "source_name string, url_hash string, crawl_run_id string, fetched_at timestamp, raw_object_key string, raw_content_hash string"
    import datetime as dt

    day = [dt.datetime(2024, 1, d) for d in range(1, 5)]
    stored = spark.createDataFrame([("s", "h", "r1", day[0], "k1", "x1")], schema)
    retry = spark.createDataFrame([("s", "h", "r1", day[1], "k2", "x2"), ("s", "h", "r2", day[2], "k3", "x3"), ("s", "h", "r2", day[1], "k4", "x4")], schema)
    assert [r.raw_object_key for r in dedupe.immutable_first_write(stored, retry).collect()] == ["k4"]
    assert sorted((r.crawl_run_id, r.raw_object_key, r.raw_content_hash) for r in dedupe.first_write_keys(stored, retry).collect()) == [
        ("r1", "k1", "x1"), ("r2", "k4", "x4"), ("r2", "k4", "x4")]


def test_ids_continue_without_gaps(spark):
    rows = raw(spark, [(None, f"u{i}", "r", "SUCCESS", f"2024-01-01 00:{i % 9:02d}:{i % 50:02d}") for i in range(200)])
    numbered = dedupe.assign_ids(rows, 41)
    assert sorted(r.id for r in numbered.collect()) == list(range(42, 242))
    assert {(r.url, r.id) for r in numbered.collect()} == {(r.url, r.id) for r in dedupe.assign_ids(rows.repartition(7), 41).collect()}
    assert set(numbered.columns) <= {p.split()[0] for p in RAWDATA.split(", ")}


def test_retry_classes(spark):
    cases = [(200, None, "success"), (None, "timeout", "retryable"), (503, None, "retryable"), (429, "", "retryable"), (404, None, "permanent"),
             (None, "robots_denied", "permanent"), (500, "unsupported_content", "permanent"), (None, "connection_reset", "retryable"), (418, None, "permanent")]
    df = spark.createDataFrame(cases, "s int, e string, want string")
    assert [r.got for r in df.select(ingest.classify_retry("s", "e").alias("got")).collect()] == [c[2] for c in cases]


def test_validation_reasons(spark):
    body = "word " * 200
    cases = [("https://e.com/a", "T", body, 5, []), ("https://e.com/", "T", body, 5, ["homepage"]), ("https://e.com/a", "Checking your browser", "captcha challenge", 1, ["content_length", "captcha"]),
             ("https://e.com/a", "Page not found", None, 0, ["missing_content", "not_found_page"]), ("https://e.com/a", None, body + " captcha", 0, ["missing_title", "paragraph_count"]),
             ("https://e.com/a", "Sign in", "x" * 200, 1, ["login_wall"])]
    df = spark.createDataFrame([c[:4] for c in cases], "url string, title string, content string, paragraph_count bigint")
    assert [r.validation_errors for r in ingest.article_validation(df).collect()] == [c[4] for c in cases]
