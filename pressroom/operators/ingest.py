"""The planned ingestion tables: crawl items, raw documents, articles, attempts and their metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.functions import ids
from pressroom.functions import urls as U
from pressroom.functions.text import blank_to_null
from pressroom.operators.dedupe import first_bodies
from pressroom.operators.reports import rate
from pressroom.operators.running import balanced_buckets, running

# Outcomes worth another attempt, and outcomes that are final.
RETRYABLE_STATUS = [429, 500, 502, 503, 504]
RETRYABLE_ERRORS = ["timeout", "connection_reset"]
PERMANENT_STATUS = [400, 404, 410]
PERMANENT_ERRORS = ["invalid_url", "unsupported_content", "robots_denied"]

EXTRACTION_VERSION = "1"


def crawl_items_upsert(items: DataFrame, discovered: DataFrame) -> DataFrame:
    """One row per (source, canonical URL): first and last sighting, attempts, last error.

    ``discovered`` rows carry ``source_id, url, seen_at`` and, where an attempt was made, ``crawl_run_id,
    attempted, status, error_type, error_message``. Items that a failed feed does not mention stay as they are.
    """
    sightings = discovered.select(
        "source_id",
        U.normalize_v2("url").alias("normalized_url"),
        F.col("seen_at").alias("first_discovered_at"),
        F.col("seen_at").alias("last_discovered_at"),
        F.col("attempted").cast("bigint").alias("attempt_count"),
        F.struct("status", F.col("crawl_run_id").alias("last_crawl_run_id"), F.col("error_type").alias("last_error_type"),
                 F.col("error_message").alias("last_error_message")).alias("_state"),
    ).filter(F.col("normalized_url").isNotNull())
    known = items.select(
        "source_id", "normalized_url", "first_discovered_at", "last_discovered_at", "attempt_count",
        F.struct("status", "last_crawl_run_id", "last_error_type", "last_error_message").alias("_state"),
    )
    recency = F.struct("last_discovered_at", F.col("_state.last_crawl_run_id"), F.col("_state.status"))
    return known.unionByName(sightings).groupBy("source_id", "normalized_url").agg(
        F.min("first_discovered_at").alias("first_discovered_at"),
        F.max("last_discovered_at").alias("last_discovered_at"),
        F.sum("attempt_count").alias("attempt_count"),
        F.max_by("_state", recency).alias("_state"),
    ).select("source_id", "normalized_url", "_state.status", "first_discovered_at", "last_discovered_at",
             "_state.last_crawl_run_id", "attempt_count", "_state.last_error_type", "_state.last_error_message")


def discovery_metrics(feeds: DataFrame, entries: DataFrame, known_urls: DataFrame) -> DataFrame:
    """Per source: feeds fetched and failed, URLs discovered, new, duplicate and rejected, and the duration.

    ``feeds``: ``source_name, ok, started_at, finished_at``. ``entries``: ``source_name, raw_url`` before any
    filtering. ``known_urls``: ``source_name, url`` (canonical). The first row of a URL counts as new or known,
    further rows as duplicates, as known URLs do.
    """
    checked = entries.select("source_name", U.normalize_v2("raw_url").alias("url"))
    per_url = checked.groupBy("source_name", "url").agg(F.count(F.lit(1)).alias("_n"))
    known = known_urls.select("source_name", "url").distinct().withColumn("_known", F.lit(True))
    flagged = per_url.join(known, ["source_name", "url"], "left")
    valid = F.col("url").isNotNull()
    is_new = (valid & F.col("_known").isNull()).cast("bigint")
    urls = flagged.groupBy("source_name").agg(
        F.sum("_n").alias("urls_discovered"),
        F.sum(is_new).alias("urls_new"),
        F.sum(F.when(valid, F.col("_n") - is_new).otherwise(0)).alias("urls_duplicate"),
        F.sum(F.when(~valid, F.col("_n")).otherwise(0)).alias("urls_rejected"),
    )
    fetched = feeds.groupBy("source_name").agg(
        F.count_if("ok").alias("feeds_fetched"), F.count_if(~F.col("ok")).alias("feed_errors"),
        (F.unix_micros(F.max("finished_at")) - F.unix_micros(F.min("started_at"))).alias("duration_us"),
    )
    zero = ["urls_discovered", "urls_new", "urls_duplicate", "urls_rejected", "feeds_fetched", "feed_errors"]
    return fetched.join(urls, "source_name", "full").fillna(0, zero)


# Texts that give away a page that is no article.
CAPTCHA_MARKS = ["captcha", "checking your browser", "access denied", "verify you are human", "unusual traffic"]
NOT_FOUND_MARKS = ["404", "not found", "page not found", "không tìm thấy trang"]
LOGIN_MARKS = ["log in", "sign in", "login required", "đăng nhập"]
MIN_CONTENT, MAX_CONTENT = 150, 200_000
MIN_PARAGRAPHS, MAX_PARAGRAPHS = 1, 2_000
# Marks count in a title, or where they make up so much of the text: an article about captchas is still an article.
MARK_SHARE = 0.01


def _mentions(text: Column, marks: list[str]) -> Column:
    found = F.lit(False)
    for mark in marks:
        found = found | text.contains(mark)
    return F.coalesce(found, F.lit(False))


def _share(text: Column, marks: list[str]) -> Column:
    """The share of a text's characters that marks make up."""
    gone = F.lit(0)
    for mark in marks:
        gone = gone + F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))
    return F.coalesce(gone / F.nullif(F.length(text), F.lit(0)), F.lit(0.0))


def article_validation(
    articles: DataFrame, url: str = "url", content_length: tuple[int, int] = (MIN_CONTENT, MAX_CONTENT),
    paragraphs: tuple[int, int] = (MIN_PARAGRAPHS, MAX_PARAGRAPHS), mark_share: float = MARK_SHARE,
) -> DataFrame:
    """Names of the failed checks per article, and whether it passed. Needs ``title, content, paragraph_count``.

    Stricter than the crawl status, which a 404 template with a paragraph would pass.
    """
    content, title = blank_to_null("content"), F.lower(F.coalesce("title", F.lit("")))
    length = F.coalesce(F.char_length(content), F.lit(0))
    body = F.lower(content)

    def shows(marks: list[str]) -> Column:
        return _mentions(title, marks) | (_share(body, marks) >= mark_share)

    path = F.regexp_replace(U.path(url), "/+$", "")
    checks = {
        "missing_title": title == "",
        "missing_content": content.isNull(),
        "content_length": content.isNotNull() & ~length.between(*content_length),
        "paragraph_count": content.isNotNull() & ~F.col("paragraph_count").between(*paragraphs),
        "homepage": (path == "") | F.lower(path).isin("/index.html", "/index.htm", "/index.php"),
        "captcha": shows(CAPTCHA_MARKS),
        "not_found_page": shows(NOT_FOUND_MARKS),
        "login_wall": shows(LOGIN_MARKS),
    }
    reasons = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in checks.items()]))
    return articles.withColumn("validation_errors", reasons).withColumn("is_valid", F.size("validation_errors") == 0)


def raw_documents_backfill(rawdata: DataFrame, raw_files: DataFrame) -> DataFrame:
    """Successful rows as raw documents; size and actual hash come from the stored object."""
    objects = raw_files.select("raw_object_key", F.col("size_bytes").alias("raw_size_bytes"), F.col("content_hash").alias("actual_hash"))
    return rawdata.filter((F.col("status") == "SUCCESS") & blank_to_null("raw_object_key").isNotNull()).select(
        "id", "source_id", U.normalize_v2("url").alias("normalized_url"), "url", "final_url",
        F.coalesce("raw_payload_type", F.lit("text/html")).alias("content_type"), "http_status", "raw_object_key",
        "raw_payload_type", "raw_content_hash", "fetched_at", "created_at",
    ).join(objects, "raw_object_key", "left")


def verify_backfill(rawdata: DataFrame, documents: DataFrame) -> DataFrame:
    """Row and hash counts on both sides of the backfill, one row."""
    before = rawdata.filter((F.col("status") == "SUCCESS") & blank_to_null("raw_object_key").isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.count("raw_content_hash").alias("h"), F.bit_xor(F.xxhash64("id", "raw_content_hash")).alias("x"))
    after = documents.agg(
        F.count(F.lit(1)).alias("n"), F.count("raw_content_hash").alias("h"), F.bit_xor(F.xxhash64("id", "raw_content_hash")).alias("x"),
        F.count_if(F.col("actual_hash").isNull()).alias("missing"),
        F.count_if(F.col("raw_content_hash") != F.col("actual_hash")).alias("wrong"))
    both = before.select(F.lit(1).alias("k"), *[F.col(c).alias(f"b_{c}") for c in before.columns]).join(
        after.withColumn("k", F.lit(1)), "k")
    return both.select(
        F.col("b_n").alias("rows_expected"), F.col("n").alias("rows_written"), F.col("b_h").alias("hashes_expected"),
        F.col("h").alias("hashes_written"), F.col("missing").alias("objects_missing"), F.col("wrong").alias("hashes_wrong"),
        ((F.col("b_n") == F.col("n")) & F.col("b_x").eqNullSafe(F.col("x")) & (F.col("missing") == 0) & (F.col("wrong") == 0)).alias("verified"),
    )


def articles_build(extracted: DataFrame, raw_documents: DataFrame, now: Column | None = None) -> DataFrame:
    """Article rows that point at their raw document. The content hash is over the extracted text, not the payload."""
    now = F.current_timestamp() if now is None else now
    docs = raw_documents.select("raw_object_key", F.col("id").alias("raw_document_id"), "source_id")
    have = set(extracted.columns)

    def optional(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")

    return extracted.drop("source_id").join(docs, "raw_object_key").select(
        "source_id", "raw_document_id", "canonical_url", "title", optional("lead").alias("lead"), "content", "author", "published_at",
        optional("language").alias("language"), optional("section").alias("section"), "thumbnail_url",
        U.content_hash("content").alias("content_hash"), F.lit(EXTRACTION_VERSION).alias("extraction_version"),
        now.alias("created_at"), now.alias("updated_at"),
    )


def classify_retry(status_code: Column | str, error_type: Column | str) -> Column:
    """``success``, ``retryable`` or ``permanent`` for one attempt."""
    s, e = U.col(status_code), F.lower(U.col(error_type))
    return (
        F.when(e.isin(PERMANENT_ERRORS) | s.isin(PERMANENT_STATUS), F.lit("permanent"))
        .when(e.isin(RETRYABLE_ERRORS) | s.isin(RETRYABLE_STATUS), F.lit("retryable"))
        .when(blank_to_null(e).isNull() & s.between(200, 399), F.lit("success"))
        .otherwise(F.lit("permanent"))
    )


def retry_queue(attempts: DataFrame, max_attempts: int = 3) -> DataFrame:
    """Items whose last attempt is worth repeating, with the number of the next attempt."""
    last = attempts.groupBy("crawl_item_id").agg(
        F.max("attempt_no").alias("attempts_made"),
        F.max_by(classify_retry("status_code", "error_type"), F.struct("attempt_no", "id")).alias("last_class"),
    )
    return last.filter((F.col("last_class") == "retryable") & (F.col("attempts_made") < max_attempts)).select(
        "crawl_item_id", (F.col("attempts_made") + 1).alias("next_attempt_no"))


def politeness_schedule(queue: DataFrame, delays: DataFrame, start: Column, domain: str = "domain", order: list[str] | None = None,
                        bucket: Column | None = None, default_delay: float = 1.0) -> DataFrame:
    """Earliest fetch time per queued URL: one request per domain and delay, domains independent of each other.

    A hot domain is numbered in buckets, so its queue never has to fit one task. Buckets are balanced pieces of the
    queue unless a ``bucket`` that rises with the order is given.
    """
    order = order or ["queued_at", "url"]
    cut = balanced_buckets(queue, [domain], order) if bucket is None else queue.withColumn("_bucket", bucket)
    policy = delays.select(F.col("domain").alias("_d"), "min_delay_seconds")
    numbered = running(cut, [domain], ["_bucket"], order, {"slot": ("sum", F.lit(1).cast("bigint"))})
    delay = F.coalesce("min_delay_seconds", F.lit(default_delay)).cast("double")
    offset = ((F.col("slot") - 1) * delay * 1_000_000).cast("bigint")
    return numbered.join(policy, F.col(domain) == F.col("_d"), "left").withColumn(
        "planned_at", F.timestamp_micros(F.unix_micros(start.cast("timestamp")) + offset)
    ).drop("_d", "_bucket", "min_delay_seconds")


def reliability_metrics(attempts: DataFrame, by: str = "source_id") -> DataFrame:
    """Fetch, parse and validation figures per source from attempt rows.

    Needs ``http_status, error_type, status, is_valid, is_duplicate, response_time_ms``. Counts combine map-side.
    """
    code, n = F.col("http_status"), F.count(F.lit(1))
    fetched = F.count_if(code.between(200, 299))
    parsed = F.count_if(F.col("status") == "SUCCESS")
    return attempts.groupBy(by).agg(
        n.alias("attempts"),
        rate(fetched, n).alias("fetch_success_rate"),
        F.count_if(code.between(200, 299)).alias("status_2xx"),
        F.count_if(code.between(300, 399)).alias("status_3xx"),
        F.count_if(code.between(400, 499)).alias("status_4xx"),
        F.count_if(code >= 500).alias("status_5xx"),
        F.count_if(F.lower("error_type") == "timeout").alias("timeouts"),
        F.count_if(code == 429).alias("rate_limited"),
        F.count_if(code == 403).alias("forbidden"),
        rate(parsed, fetched).alias("parse_success_rate"),
        rate(F.count_if(~F.col("is_valid")), parsed).alias("validation_failure_rate"),
        F.count_if("is_duplicate").alias("duplicates"),
        F.avg("response_time_ms").alias("average_latency_ms"),
    )


def status_distribution(attempts: DataFrame, by: str = "source_id") -> DataFrame:
    """One row per source and HTTP status that occurs, null included; the counts of a source add up to its attempts."""
    return attempts.groupBy(by, "http_status").agg(F.count(F.lit(1)).alias("attempts"))


def mvp_metrics(crawls: DataFrame) -> DataFrame:
    """Success, emptiness, length and error figures over all crawls, one row."""
    n = F.count(F.lit(1))
    fetched = F.count_if(~F.col("status").isin("TIMEOUT", "BLOCKED", "UNKNOWN_ERROR", "EMPTY_HTML"))
    parsed = F.count_if(F.col("status") == "SUCCESS")
    return crawls.agg(
        n.alias("crawls"),
        rate(fetched, n).alias("crawl_success_rate"),
        rate(parsed, fetched).alias("parse_success_rate"),
        F.avg("duration_ms").alias("average_time_ms"),
        rate(F.count_if(F.col("status").isin("EMPTY_HTML", "CONTENT_NOT_FOUND")), n).alias("empty_rate"),
        F.avg(F.when(F.col("status") == "SUCCESS", F.char_length("content"))).alias("average_length"),
        rate(F.count_if(F.col("status").isin("TIMEOUT", "BLOCKED", "UNKNOWN_ERROR")), n).alias("error_rate"),
    )


def expired(items: DataFrame, policy: DataFrame, now: Column, referenced: DataFrame | None = None) -> DataFrame:
    """Items past the age limit of their class that nothing refers to any more.

    ``items``: ``object_class, object_key, stored_at``. ``policy``: ``object_class, keep_days``; a class
    without a policy is kept.
    """
    limits = policy.select(F.col("object_class").alias("_class"), "keep_days")
    aged = items.join(limits, F.col("object_class") == F.col("_class")).filter(
        F.unix_seconds(F.col("stored_at").cast("timestamp")) < F.unix_seconds(now.cast("timestamp")) - F.col("keep_days") * 86400
    ).drop("_class")
    return aged.join(referenced.select("object_key"), "object_key", "left_anti") if referenced is not None else aged


def content_addressed(rows: DataFrame, zone: str = "UTC", html: str = "html") -> DataFrame:
    """Payloads under a key that is their own hash; equal payloads of a source and day are stored once."""
    keyed = rows.withColumn("payload_hash", U.content_hash(html)).withColumn(
        "object_key", ids.content_addressed_key("source_name", "payload_hash", "fetched_at", zone))
    return first_bodies(keyed, ["object_key"], ["fetched_at", "url"])


def verify_checksums(objects: DataFrame, key: str = "object_key", html: str = "html") -> DataFrame:
    """Stored objects whose bytes no longer match the hash in their key."""
    stated = F.regexp_extract(key, r"([0-9a-f]{64})\.html\.gz$", 1)
    return objects.select(key, stated.alias("expected"), U.content_hash(html).alias("actual")).filter(
        ~F.col("expected").eqNullSafe(F.col("actual")))
