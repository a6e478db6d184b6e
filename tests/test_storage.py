"""Real files: sidecars, gzip objects, reconciliation, table storage and streams."""

import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from pressroom.operators import reconcile
from pressroom.plans import jobs as plans
from pressroom.schemas import RAWDATA
from pressroom.sources import artifacts, rawdata
from pressroom.sources.config import builtin_rules, builtin_sources
from pressroom.streaming import jobs
from pressroom.operators.dedupe import skip_any_artifact


def put(root, key, text):
    path = root / key
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text) if key.endswith(".gz") else text)
    return key


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.fixture
def store(spark, tmp_path):
    """One of everything that can be wrong, next to something that is right."""
    raw, meta = "crawl_data/raw/s/2026/01/02/", "crawl_data/metadata/s/2026/01/02/"
    put(tmp_path, raw + "good.html.gz", b"good")
    put(tmp_path, raw + "orphan+1 %.html.gz", b"orphan")
    put(tmp_path, raw + "wrong.html.gz", b"\xffbytes")
    docs = {
        "0123456789abcdef_1.json": {"schema_version": 2, "raw_object_key": raw + "good.html.gz", "raw_content_hash": sha(b"good")},
        "fedcba9876543210_1.json": {"raw_html_path": raw + "gone.html.gz", "crawl_status": "SUCCESS"},
        "00000000000000aa_1.json": {"schema_version": 2, "raw_object_key": None},
        "00000000000000bb_1.json": {"schema_version": 2, "raw_object_key": raw + "wrong.html.gz", "raw_content_hash": "bad"},
        "00000000000000cc_1.json": [1, 2],
    }
    for name, doc in docs.items():
        put(tmp_path, meta + name, json.dumps(doc).encode())
    put(tmp_path, meta + "00000000000000dd_1.json", b"{broken")
    rows = spark.createDataFrame(
        [(1, 1, "u", raw + "good.html.gz", sha(b"good"), "SUCCESS", "r"), (2, 1, "u", None, None, "TIMEOUT", "r"), (3, 1, "v", "../x.html.gz", "h", "SUCCESS", "r"),
         (4, 1, "w", raw + "wrong.html.gz", sha(b"\xffbytes"), "SUCCESS", None), (5, 1, "w", "", None, "SUCCESS", None)],
        "id bigint, source_id bigint, url string, raw_object_key string, raw_content_hash string, status string, crawl_run_id string")
    return tmp_path, raw, meta, rows


def test_files_are_read_as_they_are(spark, store):
    root, raw, meta, _ = store
    objects = {r.raw_object_key: (r.content_hash, r.size_bytes) for r in artifacts.read_raw_html(spark, str(root)).collect()}
    assert objects == {raw + "good.html.gz": (sha(b"good"), 4), raw + "orphan+1 %.html.gz": (sha(b"orphan"), 6), raw + "wrong.html.gz": (sha(b"\xffbytes"), 6)}
    assert {r[0] for r in artifacts.raw_object_keys(spark, str(root)).collect()} == set(objects)
    sidecars = artifacts.read_metadata(spark, str(root)).collect()
    assert len(sidecars) == 5 and [r.metadata_path for r in sidecars if not r.readable] == [meta + "00000000000000dd_1.json"]


def test_all_seven_findings(spark, store):
    root, raw, meta, rows = store
    found = plans.reconcile_stored(artifacts.read_metadata(spark, str(root)), rows, artifacts.read_raw_html(spark, str(root)), str(root / "work")).collect()
    got = {(r.category, r.metadata_path and r.metadata_path[len(meta):][:16], r.raw_object_key, r.database_id) for r in found}
    assert len(found) == len(got) and got == {
        ("raw_files_without_database_row", None, raw + "orphan+1 %.html.gz", None),
        ("database_rows_without_raw_file", "fedcba9876543210", raw + "gone.html.gz", None),
        ("database_rows_without_raw_file", None, "../x.html.gz", 3),
        ("hash_mismatches", "00000000000000bb", raw + "wrong.html.gz", 4),
        ("legacy_metadata_without_database_reference", "fedcba9876543210", raw + "gone.html.gz", None),
        ("metadata_without_database_reference", "00000000000000aa", None, None),
        ("metadata_without_database_reference", "00000000000000dd", None, None),
        ("metadata_without_raw_reference", "00000000000000aa", None, None),
        ("database_duplicate_run_urls", None, raw + "good.html.gz", 1), ("database_duplicate_run_urls", None, None, 2),
        ("database_duplicate_run_urls", None, raw + "wrong.html.gz", 4), ("database_duplicate_run_urls", None, "", 5),
    }


def test_files_only(spark, store):
    root, raw, meta, _ = store
    report = reconcile.reconcile_report(artifacts.read_metadata(spark, str(root)), None, artifacts.read_raw_html(spark, str(root)))
    counts = {r.category: r.findings for r in reconcile.report_summary(report).collect()}
    assert counts == {"raw_files_without_database_row": 3, "database_rows_without_raw_file": 1, "hash_mismatches": 1, "legacy_metadata_without_database_reference": 1,
                      "metadata_without_database_reference": 4, "metadata_without_raw_reference": 1}


def test_sidecars_block_a_second_crawl(spark, store):
    root = store[0]
    known = artifacts.artifact_keys(artifacts.read_metadata(spark, str(root)))
    wanted = spark.createDataFrame([("s", "0123456789abcdef"), ("s", "00000000000000dd"), ("s", "1111111111111111"), ("t", "fedcba9876543210")], "source_name string, url_hash string")
    assert {r.url_hash for r in skip_any_artifact(wanted, known).collect()} == {"00000000000000dd", "1111111111111111"}


def crawled(spark):
    rows = [("my site", "https://e.com/1", None, "<p>x</p>", "2026-08-30 20:00:00.5"), ("my site", "https://e.com/2", "https://e.com/2b", " ", "2026-08-30 01:00:00")]
    df = spark.createDataFrame(rows, "source_name string, url string, final_url string, html string, t string")
    return df.withColumns({"fetched_at": F.col("t").cast("timestamp"), "status": F.lit("SUCCESS"), "http_status": F.lit(200), "crawl_run_id": F.lit("r")}).drop("t")


def test_written_artifacts(spark, tmp_path):
    artifacts.write_artifacts(artifacts.artifact_rows(crawled(spark), "Asia/Ho_Chi_Minh"), str(tmp_path))
    meta = {r.url[-1]: r for r in artifacts.read_metadata_table(spark, str(tmp_path)).collect()}
    assert meta["1"].raw_object_key.startswith("crawl_data/raw/my_site/2026/08/31/") and meta["1"].final_url == "https://e.com/1"
    assert meta["1"].fetched_at_text == "2026-08-30T20:00:00.500000+00:00" and meta["1"].raw_content_hash == sha(b"<p>x</p>")
    assert meta["2"].raw_object_key is None and meta["2"].raw_content_hash is None and meta["2"].final_url == "https://e.com/2b"
    assert [r.size_bytes for r in artifacts.read_raw_table(spark, str(tmp_path)).collect()] == [8]


def batch(spark, rows):
    df = spark.createDataFrame(rows, "url string, crawl_run_id string, status string, fetched_at string")
    full = rawdata.rawdata_record(df.withColumn("source_id", F.lit(3)), F.lit("2030-01-01").cast("timestamp"))
    return spark.createDataFrame(full.collect(), RAWDATA)


def test_insert_defaults(spark):
    df = spark.createDataFrame([("u", "", "p", "", "", "boom", ""), ("v", "k", "p", "TIMEOUT", "x", None, "2024-01-01")],
                               "url string, raw_object_key string, raw_html_path string, crawl_status string, error_message string, error string, fetched_at string")
    a, b = rawdata.rawdata_record(df, F.lit("2030-01-01").cast("timestamp")).orderBy("url").collect()
    assert (a.source_id, a.raw_object_key, a.raw_payload_type, a.status, a.error_message, a.fetched_at.year) == (1, "p", "text/html", "SUCCESS", "boom", 2030)
    assert (b.raw_object_key, b.status, b.error_message, b.fetched_at.year, b.created_at.year) == ("k", "TIMEOUT", "x", 2024, 2030)
    assert a.crawl_run_id != b.crawl_run_id and len(a.crawl_run_id) == 36


def test_merge_survives_a_crash_and_touches_only_its_runs(spark, tmp_path):
    table, stage = str(tmp_path / "table"), str(tmp_path / "stage")
    rawdata.merge_into_storage(spark, batch(spark, [("u", "r1", "TIMEOUT", "2024-01-01"), ("v", "r2", "SUCCESS", "2024-01-01")]), table, f"{stage}/0")
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "table" / "crawl_run_id=r2").iterdir() if p.suffix == ".parquet"}
    second = batch(spark, [("u", "r1", "SUCCESS", "2024-01-02"), ("w", "r1", "SUCCESS", "2024-01-02")])
    rawdata.merge_into_storage(spark, second, table, f"{stage}/1")
    once = sorted(map(tuple, rawdata.read_rawdata(spark, table).collect()))
    # The job died after the merge was staged and runs again; later the staging folder is lost and it runs once more.
    rawdata.merge_into_storage(spark, second, table, f"{stage}/1")
    rawdata.merge_into_storage(spark, second, table, f"{stage}/2")
    assert sorted(map(tuple, rawdata.read_rawdata(spark, table).collect())) == once
    assert sorted((r.url, r.status) for r in rawdata.read_rawdata(spark, table).collect()) == [("u", "SUCCESS"), ("v", "SUCCESS"), ("w", "SUCCESS")] and sorted(r[0] for r in once) == [1, 2, 3]
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "table" / "crawl_run_id=r2").iterdir() if p.suffix == ".parquet"}
    assert before == after


def test_replayed_url_batch_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "urls")

    def rows(*urls):
        return spark.createDataFrame([("s", u) for u in urls], "source_name string, url string")

    jobs.append_new_urls(rows("a", "b", "a"), 0, table)
    jobs.append_new_urls(rows("b", "c"), 1, table)
    jobs.append_new_urls(rows("b", "c"), 1, table)
    assert sorted((r.url, r.batch_id) for r in spark.read.parquet(table).collect()) == [("a", 0), ("b", 0), ("c", 1)]


PAGE = "<h1>Title {0}</h1><article><p>" + "Content of page {0}. " * 20 + "</p></article>"


def test_collection_run(spark, tmp_path):
    discovered = spark.createDataFrame(
        [("vnexpress", f"https://vnexpress.net/{i}.html", None, "hint", None, "Hinted author", None, "rss", "{}", [i]) for i in range(4)],
        "source_name string, url string, title string, published_at string, summary string, author string, thumbnail_url string, discovery_method string, raw_metadata string, position array<bigint>")
    stored = spark.createDataFrame([("vnexpress", sha(b"https://vnexpress.net/0.html")[:16], "p", True)], "source_name string, url_hash string, metadata_path string, readable boolean").withColumn(
        "modified_at", F.current_timestamp())
    pages = spark.createDataFrame([("vnexpress", f"https://vnexpress.net/{i}.html", PAGE.format(i) if i == 1 else " ") for i in (1, 2)], "source_name string, url string, html string")
    done, stats = plans.collect_news(discovered, stored, pages, builtin_sources(spark), builtin_rules(spark), work=str(tmp_path / "work"))
    got = {r.url[-6]: (r.status, r.title, r.author, r.published_at, r.quality_flags) for r in done.collect()}
    assert got["1"] == ("SUCCESS", "Title 1", "Hinted author", "hint", ["missing_author", "missing_published_at"]) and got["2"][0] == "EMPTY_HTML"
    total = [r for r in stats.collect() if r.is_total][0]
    assert (total.discovered, total.skipped, total.success, total.failed) == (4, 1, 1, 2)


def test_scheduled_run(spark, tmp_path):
    lists = spark.createDataFrame([("run", 1, "https://E.com/a?utm_source=x, https://e.com/b,https://e.com/c,bad")], "crawl_run_id string, source_id bigint, urls string")
    earlier = batch(spark, [("https://e.com/c", "run", "SUCCESS", "2024-01-01"), ("https://e.com/a", "run", "TIMEOUT", "2024-01-01")]).withColumn("source_id", F.lit(1).cast("bigint"))
    pages = spark.createDataFrame([("https://e.com/a", PAGE.format("a"), None), ("https://e.com/b", None, "timeout"), ("https://e.com/z", PAGE.format("z"), None)],
                                  "url string, html string, error_kind string")
    outcomes, done, rejected = plans.scheduled_batch(lists, earlier, pages, builtin_sources(spark), builtin_rules(spark), work=str(tmp_path / "work"))
    assert {r.url[-1]: r.status for r in outcomes.collect()} == {"a": "SUCCESS", "b": "TIMEOUT", "c": "SKIPPED_EXISTING"}
    assert sorted(r.url[-1] for r in done.collect()) == ["a", "b"] and [r.raw_url for r in rejected.collect()] == ["bad"]


def test_ids_are_noted_beside_the_table(spark, tmp_path):
    table, stage = str(tmp_path / "table"), str(tmp_path / "stage")
    assert rawdata.highest_id(spark, table) is None
    rawdata.merge_into_storage(spark, batch(spark, [(f"u{i}", "r1", "SUCCESS", "2024-01-01") for i in range(5)]), table, f"{stage}/0")
    assert rawdata.highest_id(spark, table) == 5
    rawdata.merge_into_storage(spark, batch(spark, [("u1", "r1", "TIMEOUT", "2024-01-02"), ("v", "r2", "SUCCESS", "2024-01-02")]), table, f"{stage}/1")
    assert rawdata.highest_id(spark, table) == 6 and sorted(r.id for r in rawdata.read_rawdata(spark, table).collect()) == [1, 2, 3, 4, 5, 6]
    # a table from before there were notes
    for note in (tmp_path / "table" / "_ids").iterdir():
        note.unlink()
    rawdata.merge_into_storage(spark, batch(spark, [("w", "r3", "SUCCESS", "2024-01-03")]), table, f"{stage}/2")
    assert rawdata.highest_id(spark, table) == 7 and {r.url: r.id for r in rawdata.read_rawdata(spark, table).collect()}["w"] == 7


@pytest.mark.parametrize("named", [1000, 0])
def test_a_merge_reads_its_runs_only(spark, tmp_path, monkeypatch, named):
    monkeypatch.setattr(rawdata, "NAMED_RUNS", named)
    table, stage = str(tmp_path / "table"), str(tmp_path / "stage")
    rows = batch(spark, [("u", "r1", "SUCCESS", "2024-01-01"), ("v", "r2", "SUCCESS", "2024-01-01"), ("x", "gone", "SUCCESS", "2024-01-01")])
    rows = rows.withColumn("crawl_run_id", F.nullif("crawl_run_id", F.lit("gone")))
    rawdata.merge_into_storage(spark, rows, table, f"{stage}/0")
    late = batch(spark, [("y", "gone", "SUCCESS", "2024-01-02"), ("u", "r1", "TIMEOUT", "2024-01-02")]).withColumn("crawl_run_id", F.nullif("crawl_run_id", F.lit("gone")))
    if named:
        touched = rawdata._touched(rawdata.read_rawdata(spark, table), late)
        files = {f.rsplit("/", 2)[-2] for f in touched.inputFiles()}
        plan = touched._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [(" in plan and "Join" not in plan and files
    rawdata.merge_into_storage(spark, late, table, f"{stage}/1")
    assert sorted((r.url, r.crawl_run_id or "", r.status) for r in rawdata.read_rawdata(spark, table).collect()) == [
        ("u", "r1", "TIMEOUT"), ("v", "r2", "SUCCESS"), ("x", "", "SUCCESS"), ("y", "", "SUCCESS")]


def test_sources_are_discovered_the_way_they_are_configured(spark):
    from pressroom.schemas import SOURCES
    from pressroom.sources.config import small_table

    sources = small_table(spark, [{"source_id": 1, "source_name": "Lists", "channel_type": "html", "domains": ["lists.test"]},
                                  {"source_id": 2, "source_name": "feeds", "channel_type": "rss", "domains": ["feeds.test"]}], SOURCES)
    html = '<a href="https://lists.test/news/1.html">A long enough title</a><a href="https://feeds.test/news/2.html">A long enough title</a>'
    listings = spark.createDataFrame([(s, 0, f"https://{s}.test/", 200, html) for s in ("lists", "feeds", "other")],
                                     "source_name string, listing_pos int, listing_url string, http_status int, html string")
    feed = "<rss><channel><item><title>T</title><link>https://feeds.test/a.html</link></item></channel></rss>"
    feeds = spark.createDataFrame([(s, 0, f"https://{s}.test/rss", 200, feed) for s in ("lists", "feeds", "other")],
                                  "source_name string, feed_pos int, feed_url string, http_status int, payload string")
    got = sorted((r.source_name, r.url, r.discovery_method) for r in plans.discover_all(feeds, None, listings, sources).collect())
    assert got == [("feeds", "https://feeds.test/a.html", "rss"), ("lists", "https://lists.test/news/1.html", "listing")]
