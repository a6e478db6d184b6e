"""The three end-to-end jobs: collection, scheduled batch, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.functions import urls as U
from pressroom.functions.text import blank_to_null
from pressroom.operators import quality
from pressroom.operators.dedupe import resolve_source, skip_any_artifact, skip_done_in_run
from pressroom.operators.discover import discover_api, discover_listing, discover_rss, parse_url_list, route_collector
from pressroom.operators.extract import SCALAR_FIELDS, extract_articles
from pressroom.operators.reconcile import reconcile_report
from pressroom.operators.reports import SKIPPED, run_stats
from pressroom.session import bounded_broadcast, materialize


def pages_with(pages: DataFrame, keys: DataFrame, url_hash: Column) -> DataFrame:
    """The pages whose hash is among ``keys.url_hash``, told before anything looks into their HTML.

    The keys are written out first. Up to the broadcast limit they go to the pages; beyond it the pages that have a partner are
    shuffled once. A null hash among the keys stands for the pages without a URL.
    """
    wanted = materialize(keys.select(F.col("url_hash").alias("_wanted")).distinct())
    return pages.join(bounded_broadcast(wanted), url_hash.eqNullSafe(F.col("_wanted")), "left_semi")


def crawl_articles(pages: DataFrame, sources: DataFrame, source_rules: DataFrame, named: str | None = None) -> DataFrame:
    """Fetched pages to article rows with status, flags and error text; pages never leave their partition.

    ``pages``: ``url, final_url, html, http_status, error_kind, error, fetched_at``; missing ones count as null.
    """
    kinds = {"final_url": "string", "http_status": "int", "error_kind": "string", "error": "string"}
    absent = {c: F.lit(None).cast(t) for c, t in kinds.items() if c not in pages.columns}
    landed = pages.withColumns(absent).withColumn("url", U.normalize_v1("url"))
    resolved = resolve_source(landed, sources, named=named).withColumn("_blank", quality.is_blank("html"))
    articles = extract_articles(resolved, source_rules)
    # A blank page is all the status needs to know about the HTML, which is gone by now.
    page_mark = F.when(F.col("_blank"), F.lit("")).otherwise("x")
    with_status = articles.withColumn("status", quality.crawl_status(page_mark, "content", "error_kind"))
    return with_status.withColumns(
        {
            "final_url": F.coalesce(blank_to_null("final_url"), F.col("url")),
            "error_message": quality.status_error("status", "error"),
        }
    ).drop("_blank", "error")


def discover_all(feeds: DataFrame | None, api_attempts: DataFrame | None, listings: DataFrame | None, sources: DataFrame,
                 limit: int | None = None) -> DataFrame:
    """Articles of all sources, each discovered the one way that its configuration asks for.

    What landed of a source over another channel, or of a source that is not configured, is not looked at. The first find of a URL per source stays.
    """
    routes = bounded_broadcast(route_collector(sources).select(F.lower("source_name").alias("_route"), "collector"))

    def of(landed: DataFrame, collector: str) -> DataFrame:
        return landed.join(routes.where(F.col("collector") == collector), F.lower("source_name") == F.col("_route"), "left_semi")

    parts = []
    if feeds is not None:
        parts.append(discover_rss(of(feeds, "rss"), limit))
    if api_attempts is not None:
        parts.append(discover_api(of(api_attempts, "api"), sources, limit))
    if listings is not None:
        parts.append(discover_listing(of(listings, "listing"), sources, limit))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def collect_news(discovered: DataFrame, artifacts: DataFrame, pages: DataFrame, sources: DataFrame, source_rules: DataFrame,
                 force: bool = False, work: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(articles, statistics): skip what has an artifact, then take the articles of the rest.

    ``pages`` are the landed responses to earlier discoveries, with the ``source_name`` they were fetched for.
    What is new is told on keys first, and only pages of new URLs are looked into, where they lie. A discovered
    URL without a page counts as failed. Pages are extracted once, into ``work`` or the checkpoint folder, because
    articles and statistics both need the result. So is discovery run once, and what it found and what of it is new written out.
    """
    keys = ["source_name", "url"]
    candidates = materialize(discovered.withColumn("url_hash", U.short_hash("url")))
    fresh = materialize(skip_any_artifact(candidates, artifacts, force))
    hints = fresh.select(*keys, "discovery_method", F.col("raw_metadata").alias("discovery_metadata"),
                         *[F.col(f).alias(f"_hint_{f}") for f in SCALAR_FIELDS])
    filled = {f: F.coalesce(blank_to_null(f), blank_to_null(f"_hint_{f}")) for f in SCALAR_FIELDS}
    new_pages = pages_with(pages, fresh, U.short_hash(U.normalize_v1("url")))
    extracted = materialize(crawl_articles(new_pages, sources, source_rules, named="source_name"), work)
    articles = extracted.join(hints, keys).withColumns(filled).drop(*[f"_hint_{f}" for f in SCALAR_FIELDS])
    done = extracted.select(*keys, "status")
    fetched = fresh.select(*keys).join(done, keys, "left").withColumn("status", F.coalesce("status", F.lit("UNKNOWN_ERROR")))
    skipped = candidates.select(*keys).join(fresh.select(*keys), keys, "left_anti").withColumn("status", F.lit(SKIPPED))
    return articles, run_stats(fetched.unionByName(skipped))


def scheduled_batch(url_lists: DataFrame, rawdata: DataFrame, pages: DataFrame, sources: DataFrame, source_rules: DataFrame,
                    list_id: str = "crawl_run_id", urls: str = "urls", work: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(outcomes, articles, rejected URLs) of a run over configured URL lists.

    ``url_lists`` has the run id, ``source_id`` and the comma-separated list. URLs already crawled with success in
    the run are skipped; one failing URL does not stop the others.
    """
    accepted, rejected = parse_url_list(url_lists, list_id, urls)
    runs = url_lists.select(list_id, "source_id")
    marked = skip_done_in_run(accepted.join(runs, list_id).withColumnRenamed(list_id, "crawl_run_id"), rawdata)
    pending = marked.filter(F.col("action") == "PENDING").select("crawl_run_id", "url", F.col("source_id").alias("_run_source"))
    wanted = pages_with(pages, pending.select(U.short_hash("url").alias("url_hash")), U.short_hash(U.normalize_v2(U.normalize_v1("url"))))
    extracted = materialize(crawl_articles(wanted, sources, source_rules).withColumn("url", U.normalize_v2("url")), work)
    articles = extracted.join(pending, "url").withColumn("source_id", F.col("_run_source")).drop("_run_source")
    done = articles.select("source_id", "crawl_run_id", "url", F.col("status").alias("_status"))
    outcomes = marked.join(done, ["source_id", "crawl_run_id", "url"], "left").withColumn(
        "status", F.when(F.col("action") == SKIPPED, F.lit(SKIPPED)).otherwise(F.coalesce("_status", F.lit("UNKNOWN_ERROR"))))
    return outcomes.drop("_status", "action"), articles, rejected


def reconcile_stored(metadata: DataFrame, rows: DataFrame | None, raw_files: DataFrame, work: str | None = None) -> DataFrame:
    """Reconcile with every sidecar parsed and every object read and hashed exactly once.

    The few columns the checks need are written out first; the seven checks read those.
    """
    facts = metadata.select("metadata_path", "readable", "schema_version", "raw_object_key", "raw_content_hash")
    sidecars = materialize(facts, work and f"{work}/sidecars")
    objects = materialize(raw_files.select("raw_object_key", "content_hash"), work and f"{work}/objects")
    return reconcile_report(sidecars, rows, objects)


def new_page_quality(pages: DataFrame, known: DataFrame, sources: DataFrame, source_rules: DataFrame) -> DataFrame:
    """Which pages are new, and which of them became good articles: statistics per source with a total row.

    Which pages are new is told on their hashes alone, so known pages are never parsed.
    """
    hashes = pages.select(U.url_hash_v1("url").alias("url_hash"))
    fresh_keys = hashes.join(known.select("url_hash"), "url_hash", "left_anti")
    articles = crawl_articles(pages_with(pages, fresh_keys, U.url_hash_v1("url")), sources, source_rules)
    fresh = articles.select(
        "source_name", "status", "paragraph_count",
        ((F.col("status") == "SUCCESS") & ~F.array_contains("quality_flags", "short_content")).alias("is_good"),
    )
    return fresh.rollup("source_name").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("status") == "SUCCESS").alias("success"),
        F.count_if(F.col("status") != "SUCCESS").alias("failed"),
        F.count_if("is_good").alias("good_articles"),
        F.sum("paragraph_count").alias("paragraphs"),
    )
