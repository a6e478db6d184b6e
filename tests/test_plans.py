"""Physical plans: what must not be in them at scale."""

import pytest
from pyspark.sql import functions as F

from pressroom.functions import text, urls
from pressroom.operators import dedupe, extract, ingest, reports
from pressroom.plans import jobs
from pressroom.session import bounded_broadcast
from pressroom.sources.config import builtin_rules, builtin_sources
from suite import views

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text_):
    return [line for line in text_.splitlines() if "Exchange hashpartitioning" in line or "Exchange RoundRobin" in line or "Exchange SinglePartition" in line]


@pytest.fixture(scope="module")
def pages(spark):
    return views.table(spark, SF, "pages")


def test_functions_stay_out_of_python(pages):
    columns = [urls.normalize_v1("url"), urls.normalize_v2("url"), urls.is_valid("url"), urls.url_join("url", F.lit("../x")), text.clean_text("html"),
               text.strip_html("html"), text.word_count("html"), text.parse_published_at("url")]
    p = plan(pages.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]))
    assert "Python" not in p and "Exchange" not in p


def test_source_lookup_is_no_nested_loop_and_moves_no_row(spark, pages):
    p = plan(dedupe.resolve_source(pages, builtin_sources(spark)))
    assert "NestedLoop" not in p and "Cartesian" not in p and not exchanges(p)
    by_join = plan(dedupe.resolve_source(pages, builtin_sources(spark), in_row_domains=0))
    assert "NestedLoop" not in by_join and "Cartesian" not in by_join


def test_extraction_shuffles_no_page(spark, pages):
    p = plan(jobs.crawl_articles(pages, builtin_sources(spark), builtin_rules(spark)))
    assert "NestedLoop" not in p and p.count("ArrowEvalPython") == 1
    # The only shuffle is the one that groups the rules of a source.
    assert all("html" not in line for line in exchanges(p)) and len(exchanges(p)) <= 1


def test_page_scan_reads_only_what_is_used(pages):
    p = plan(pages.select(urls.url_hash_v1("url")))
    assert "ReadSchema: struct<url:string>" in p


def test_flagship_keeps_html_out_of_the_shuffle(spark, pages):
    known = pages.select(urls.url_hash_v1("url").alias("url_hash"))
    p = plan(jobs.new_page_quality(pages, known, builtin_sources(spark), builtin_rules(spark)))
    assert "NestedLoop" not in p and p.count("ArrowEvalPython") == 1


def test_first_wins_is_cut_before_the_shuffle(spark):
    p = plan(dedupe.dedupe_first_wins(views.crawl_log(spark, SF), ["fetched_at", "id"], source="source_id"))
    assert p.index("WindowGroupLimit") < p.index("Exchange hashpartitioning") < p.rindex("WindowGroupLimit")


def test_top_k_and_success_filter_push_down(spark):
    assert "TakeOrderedAndProject" in plan(reports.latest_rawdata(views.crawl_log(spark, SF)))
    stored = spark.read.parquet(f"{SF}/events.parquet").withColumnRenamed("event_type", "status").withColumn("url", F.col("props"))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,SUCCESS)" in plan(dedupe.known_success(stored, ["url"]))


def test_hot_domain_is_cut_along_its_queue(spark):
    """All rows share one domain and one moment, and still spread over buckets of similar size."""
    from pressroom.operators.running import balanced_buckets

    queue = views.crawl_log(spark, SF).select(F.lit("d").alias("domain"), F.lit("2024-01-01").cast("timestamp").alias("queued_at"), "id")
    # Left on, this setting would merge pieces as small as these.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = balanced_buckets(queue.repartition(6), ["domain"], ["queued_at", "id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in cut.groupBy("_bucket").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.6 * sum(sizes)
    delays = spark.createDataFrame([("d", 2.0)], "domain string, min_delay_seconds double")
    plan_rows = ingest.politeness_schedule(queue, delays, F.lit("2024-01-01").cast("timestamp"), order=["queued_at", "id"]).orderBy("id").collect()
    assert [r.slot for r in plan_rows] == list(range(1, len(plan_rows) + 1))
    assert (plan_rows[10].planned_at - plan_rows[0].planned_at).total_seconds() == 20


def test_large_limits_are_exact(spark):
    rows = views.crawl_log(spark, SF).select(F.lit("s").alias("source_name"), "id").crossJoin(spark.range(3).withColumnRenamed("id", "k")).repartition(5)
    kept = dedupe.limit_per_source(rows, ["id", "k"], 1500).collect()
    assert len(kept) == 1500 and sorted((r.id, r.k) for r in kept)[-1] == (499, 2)


def test_broadcast_is_asked_for_only_under_the_limit(spark):
    small = builtin_sources(spark)
    assert "ResolvedHint" in bounded_broadcast(small)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in bounded_broadcast(small, limit=10)._jdf.queryExecution().analyzed().toString()


def test_rules_reach_pages_without_a_broadcast_too(spark):
    html = "<h1>T</h1><article><p>text</p></article>"
    pages = spark.createDataFrame([(i, html) for i in range(3)], "i int, html string").withColumn("rule_set", F.concat(F.lit("generic"), F.substring("html", 1, 0)))
    joined = extract.with_rules(pages, builtin_rules(spark))
    assert joined.filter(F.size("rules") > 5).count() == 3


def test_pages_without_url_are_counted(spark):
    html = "<html><body><h1>T</h1><p>text</p></body></html>"
    rows = [("https://example.com/a/1.html", html), ("https://example.com/a/2.html", html), (None, html), (None, html)]
    pages = spark.createDataFrame(rows, "url string, html string")
    known = spark.createDataFrame([(rows[0][0],)], "url string").select(jobs.U.url_hash_v1("url").alias("url_hash"))
    got = jobs.new_page_quality(pages, known, builtin_sources(spark), builtin_rules(spark)).collect()
    assert max(r.pages for r in got) == 3


def test_bodies_are_fetched_once_and_ids_need_no_single_task(spark):
    log = views.crawl_log(spark, SF).withColumn("raw_content_hash", F.sha2("props", 256)).withColumn("body", F.repeat("props", 3))
    keys = ["source_id", "url", "crawl_run_id"]
    p = plan(dedupe.immutable_first_write(log.filter(F.hour("fetched_at") < 2), log, keys))
    assert "Window" not in p and p.count("Exchange hashpartitioning") <= 2
    rows = log.select("source_id", "crawl_run_id", "url", "fetched_at", F.lit(None).cast("bigint").alias("id"))
    assert "SinglePartition" not in plan(dedupe.assign_ids(rows, 0))


def test_first_body_of_nulls_and_copies(spark):
    rows = [("a", 2, "late"), ("a", 1, "first"), ("a", 1, "first"), (None, 5, "x"), (None, None, "y"), ("b", None, "z")]
    df = spark.createDataFrame(rows, "k string, t int, body string").repartition(3)
    assert sorted((r.k or "", r.body) for r in dedupe.first_bodies(df, ["k"], ["t"]).collect()) == [("", "y"), ("a", "first"), ("b", "z")]


def test_collection_discovers_once(spark):
    from suite.articles import _collection

    articles, stats = jobs.collect_news(*_collection(spark, SF))
    assert "Python" not in plan(stats) and "Python" not in plan(articles)
