"""Discovery: landed feed, API and listing payloads become candidate articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pressroom.functions import text as T
from pressroom.functions import urls as U
from pressroom.functions.urls import let
from pressroom.operators import dom
from pressroom.operators.dedupe import GROUP_LIMIT, dedupe_first_wins, limit_per_source, pick_first
from pressroom.operators.running import balanced_buckets, running
from pressroom.session import bounded_broadcast, materialize

BLOCKED_FEED = [403, 429]
MAX_ATTEMPTS_PER_PAGE = 3
BREAKER_LIMIT = 3

# Keys tried for the item list of an API answer without a configured path.
ITEM_KEYS = ["items", "articles", "data", "posts", "results"]

_TEXT = "struct<_VALUE string>"
_RSS_ITEM = (
    "struct<title string, link array<string>, guid struct<_VALUE string, _isPermaLink string>, pubDate string, "
    "`dc:date` string, author string, `dc:creator` string, description string, `content:encoded` string, "
    "`media:content` array<struct<_url string>>, `media:thumbnail` array<struct<_url string>>, "
    "enclosure array<struct<_url string, _type string>>>"
)
_ATOM_ENTRY = (
    "struct<title string, link array<struct<_href string, _rel string, _type string>>, id string, published string, "
    "updated string, author array<struct<name string>>, `dc:creator` string, summary string, content string, "
    "`media:content` array<struct<_url string>>, `media:thumbnail` array<struct<_url string>>>"
)
FEED_TYPE = f"channel struct<item array<{_RSS_ITEM}>>, entry array<{_ATOM_ENTRY}>"

ENTRY_FIELDS = ["link", "title", "guid", "published", "updated", "author", "creator", "summary", "content", "media_content",
                "media_thumbnail", "enclosures"]


def parse_feeds(feeds: DataFrame) -> DataFrame:
    """Feed payloads with their entries in one shape for RSS and Atom; ``entries`` is null when the XML is malformed."""

    def rss(i: Column) -> Column:
        permalink = F.when(F.coalesce(F.lower(i["guid"]["_isPermaLink"]), F.lit("true")) != "false", i["guid"]["_VALUE"])
        return F.struct(
            F.coalesce(T.clean_text(dom.first_or_null(i["link"])), T.clean_text(permalink)).alias("link"),
            i["title"].alias("title"), i["guid"]["_VALUE"].alias("guid"),
            i["pubDate"].alias("published"), i["dc:date"].alias("updated"),
            i["author"].alias("author"), i["dc:creator"].alias("creator"),
            i["description"].alias("summary"), i["content:encoded"].alias("content"),
            F.transform(i["media:content"], lambda m: m["_url"]).alias("media_content"),
            F.transform(i["media:thumbnail"], lambda m: m["_url"]).alias("media_thumbnail"),
            F.transform(i["enclosure"], lambda e: F.struct(e["_url"].alias("url"), e["_type"].alias("type"))).alias("enclosures"),
        )

    def atom(e: Column) -> Column:
        main = F.filter(e["link"], lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
        attached = F.filter(e["link"], lambda x: x["_rel"] == "enclosure")
        return F.struct(
            T.clean_text(dom.first_or_null(main)["_href"]).alias("link"),
            e["title"].alias("title"), e["id"].alias("guid"), e["published"].alias("published"), e["updated"].alias("updated"),
            dom.first_or_null(e["author"])["name"].alias("author"), e["dc:creator"].alias("creator"),
            e["summary"].alias("summary"), e["content"].alias("content"),
            F.transform(e["media:content"], lambda m: m["_url"]).alias("media_content"),
            F.transform(e["media:thumbnail"], lambda m: m["_url"]).alias("media_thumbnail"),
            F.transform(attached, lambda a: F.struct(a["_href"].alias("url"), a["_type"].alias("type"))).alias("enclosures"),
        )

    parsed = feeds.withColumn("_feed", F.from_xml("payload", FEED_TYPE, {"mode": "PERMISSIVE"}))
    has_entries = F.col("_feed.channel").isNotNull() | F.col("_feed.entry").isNotNull()
    return parsed.withColumn(
        "entries",
        F.when(
            has_entries,
            F.concat(
                F.coalesce(F.transform("_feed.channel.item", rss), F.expr("array()")),
                F.coalesce(F.transform("_feed.entry", atom), F.expr("array()")),
            ),
        ),
    ).drop("_feed")


def rejected_feeds(feeds: DataFrame) -> DataFrame:
    """Feeds that yield nothing: blocked by status, or not readable as a feed."""
    return parse_feeds(feeds).select(
        "source_name", "feed_pos", "feed_url", "http_status",
        F.when(F.col("http_status").isin(BLOCKED_FEED), F.lit("blocked"))
        .when(F.col("entries").isNull(), F.lit("malformed")).alias("reason"),
    ).filter(F.col("reason").isNotNull())


def rss_published_at(published: Column, updated: Column) -> Column:
    """Instant as ISO text in UTC, else the cleaned raw text."""
    parsed = F.coalesce(T.parse_published_at(published), T.parse_published_at(updated))
    return F.coalesce(T.iso_timestamp(parsed), T.clean_text(F.coalesce(T.blank_to_null(published), T.blank_to_null(updated))))


def rss_author(author: Column, creator: Column) -> Column:
    return F.coalesce(T.clean_text(author), T.clean_text(creator))


def rss_thumbnail(media_content: Column, media_thumbnail: Column, enclosures: Column) -> Column:
    images = F.filter(enclosures, lambda e: F.coalesce(e["type"].contains("image"), F.lit(False)) & T.blank_to_null(e["url"]).isNotNull())
    return F.coalesce(
        T.clean_text(dom.first_or_null(media_content)), T.clean_text(dom.first_or_null(media_thumbnail)),
        T.clean_text(dom.first_or_null(images)["url"]),
    )


def rss_summary(summary: Column, content: Column) -> Column:
    return T.strip_html(F.coalesce(T.blank_to_null(summary), T.blank_to_null(content)))


def _finish(found: DataFrame, order: list[str], limit: int | None) -> DataFrame:
    """First occurrence of a URL per source wins, then the limit; the order columns stay as ``position``."""
    unique = dedupe_first_wins(found, order)
    return limit_per_source(unique, order, limit).withColumn("position", F.array(*[F.col(c).cast("bigint") for c in order])).drop(*order)


def discover_rss(feeds: DataFrame, limit: int | None = None) -> DataFrame:
    """Articles of landed feeds: ``source_name, feed_pos, feed_url, http_status, payload``."""
    open_feeds = feeds.filter(F.col("http_status").isNull() | ~F.col("http_status").isin(BLOCKED_FEED))
    entries = parse_feeds(open_feeds).select("source_name", "feed_pos", "feed_url", F.posexplode("entries").alias("item_pos", "e"))
    # Keys first: cleaning the other fields waits until duplicates are gone.
    keyed = entries.filter(T.blank_to_null("e.link").isNotNull()).withColumn("url", U.normalize_v1("e.link"))
    e = F.col("e")
    return _finish(keyed, ["feed_pos", "item_pos"], limit).select(
        "source_name", "url",
        T.clean_text(e["title"]).alias("title"),
        rss_published_at(e["published"], e["updated"]).alias("published_at"),
        rss_summary(e["summary"], e["content"]).alias("summary"),
        rss_author(e["author"], e["creator"]).alias("author"),
        rss_thumbnail(e["media_content"], e["media_thumbnail"], e["enclosures"]).alias("thumbnail_url"),
        F.lit("rss").alias("discovery_method"),
        F.to_json(F.struct("feed_url", e["guid"].alias("guid"))).alias("raw_metadata"),
        "position",
    )


def classify_attempt(http_status: Column | str) -> Column:
    """What one API answer means for the page: retry, stop or parse."""
    s = U.col(http_status)
    return (
        F.when(s == 429, F.lit("retry_rate_limit")).when(s >= 500, F.lit("retry_server_error"))
        .when(s >= 400, F.lit("stop")).when(s.isNull(), F.lit("stop")).otherwise(F.lit("parse"))
    )


def _server_error_runs(attempts: DataFrame, source: str, bucket: Column, order: list[str]) -> DataFrame:
    """Server errors since the latest reset, in two levels so that a hot source is not sorted in one task.

    Inside a bucket two windows count; across buckets only one summary row per bucket is ordered.
    """
    status = F.col("http_status")
    is_error = F.coalesce(status >= 500, F.lit(False))
    resets = ~is_error & ~F.coalesce(status == 429, F.lit(False))
    inside = W.partitionBy(source, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = (
        attempts.withColumn("_bucket", bucket)
        .withColumn("_errors", F.sum(F.when(is_error, 1).otherwise(0)).over(inside))
        # The count at the latest reset is a running maximum, because the count never falls.
        .withColumn("_base", F.max(F.when(resets, F.col("_errors"))).over(inside))
    )
    before = W.partitionBy("_s").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    summary = (
        local.groupBy(F.col(source).alias("_s"), F.col("_bucket").alias("_b"))
        .agg(F.max("_errors").alias("_e"), F.max("_base").alias("_r"))
        .withColumn("_sum", F.coalesce(F.sum("_e").over(before), F.lit(0)))
        .withColumn("_carry", F.col("_sum") - F.coalesce(F.max(F.col("_sum") + F.col("_r")).over(before), F.lit(0)))
        .select("_s", "_b", "_carry")
    )
    joined = local.join(summary, (F.col(source) == F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    run = F.when(F.col("_base").isNotNull(), F.col("_errors") - F.col("_base")).otherwise(F.col("_carry") + F.col("_errors"))
    return joined.withColumn("server_error_run", run.cast("bigint")).drop("_errors", "_base", "_bucket", "_s", "_b", "_carry")


def _trip_points(runs: DataFrame, source: str, order: list[str]) -> DataFrame:
    tripped = runs.filter(F.col("server_error_run") >= BREAKER_LIMIT)
    return tripped.groupBy(F.col(source).alias("_s")).agg(F.min(F.struct(*order)).alias("_cut"))


def _after_trip(order: list[str]) -> Column:
    return F.coalesce(F.struct(*order) > F.col("_cut"), F.lit(False))


PAGES_PER_BUCKET = 1000


def api_circuit_breaker(attempts: DataFrame, source: str = "source_name", order: list[str] | None = None,
                        bucket: Column | None = None) -> DataFrame:
    """Attempts with their outcome, the current run of server errors, and ``is_cut`` after the third one.

    A 429 leaves the run as it is, any other answer below 500 resets it. The run spans pages. The attempt that
    trips the breaker counts as made; ``is_cut`` marks the attempts after it. ``bucket`` must rise with ``order``.
    """
    order = order or ["page", "attempt"]
    bucket = F.floor(F.col("page") / PAGES_PER_BUCKET) if bucket is None else bucket
    runs = _server_error_runs(attempts, source, bucket, order)
    trips = _trip_points(runs.select(source, *order, "server_error_run"), source, order)
    return runs.join(trips, F.col(source) == F.col("_s"), "left").withColumns(
        {"outcome": classify_attempt("http_status"), "is_cut": _after_trip(order)}
    ).drop("_s", "_cut")


def decisive_attempts(attempts: DataFrame, source: str = "source_name") -> DataFrame:
    """The attempt that settles each page: the first stop or success among its first three.

    A page with neither has failed and is left out. Meant for narrow rows: payloads have no business here.
    """
    order = ["page", "attempt"]
    runs = _server_error_runs(attempts, source, F.floor(F.col("page") / PAGES_PER_BUCKET), order)
    trips = _trip_points(runs.select(source, *order, "server_error_run"), source, order)
    alive = runs.join(trips, F.col(source) == F.col("_s"), "left").filter(
        ~_after_trip(order) & (F.col("attempt") <= MAX_ATTEMPTS_PER_PAGE)
    ).withColumn("outcome", classify_attempt("http_status")).drop("_s", "_cut", "server_error_run")
    return pick_first(alive.filter(F.col("outcome").isin("stop", "parse")), [source, "page"], ["attempt"])


def _items(document: Column, data_path: Column) -> Column:
    """The item list of an answer: under the configured path, the root itself, or the first known key that holds a list."""

    def as_list(value: Column) -> Column:
        return F.when(F.schema_of_variant(value).startswith("ARRAY"), F.try_variant_get(value, "$", "array<variant>"))

    known = [as_list(F.try_variant_get(document, f"$.{k}", "variant")) for k in ITEM_KEYS]
    return F.when(T.blank_to_null(data_path).isNotNull(), as_list(T.nested_get(document, data_path))).otherwise(
        F.coalesce(as_list(document), *known)
    )


# Alias chain per field, tried after the mapped path.
API_ALIASES = {
    "url": ["url", "link", "canonical_url"],
    "title": ["title", "headline"],
    "published_at": ["published_at", "created_at"],
    "summary": ["summary", "description"],
    "author": ["author"],
    "thumbnail_url": ["cover_image", "image"],
}
# Path used when the mapping names none.
API_DEFAULT_PATHS = {"summary": "description"}


def api_field(item: Column, mapping: Column, field: str) -> Column:
    """A field of an API item: mapped path first, then the aliases; missing-like values fall through."""
    mapped = F.coalesce(F.try_element_at(mapping, F.lit(field)), F.lit(API_DEFAULT_PATHS.get(field, field)))
    options = [T.json_text(let(mapped, lambda p: T.nested_get(item, p)))]
    options += [T.json_text(F.try_variant_get(item, f"$.{alias}", "variant")) for alias in API_ALIASES[field]]
    return T.clean_text(F.coalesce(*options))


def _api_url(item: Column, mapping: Column) -> Column:
    """Only a text counts as a URL: a chain that ends at anything else drops the item."""
    mapped = F.coalesce(F.try_element_at(mapping, F.lit("url")), F.lit("url"))
    found = [let(mapped, lambda p: T.nested_get(item, p))] + [
        F.try_variant_get(item, f"$.{alias}", "variant") for alias in API_ALIASES["url"]]
    first = F.coalesce(*[F.when(T.json_text(v).isNotNull(), v) for v in found])
    return let(first, lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))


def _open_pages(settled: DataFrame) -> DataFrame:
    """Pages before the first failed, empty or missing one of their source."""
    bad = ~((F.col("outcome") == "parse") & F.coalesce(F.col("n_items") > 0, F.lit(False)))
    counted = running(
        settled.withColumn("_bucket", F.floor(F.col("page") / PAGES_PER_BUCKET)), ["source_name"], ["_bucket"], ["page"],
        {"_seen": ("sum", F.lit(1).cast("bigint")), "_bad": ("sum", F.when(bad, 1).otherwise(0).cast("bigint"))},
    )
    within = F.col("page") <= F.coalesce("max_pages", F.lit(1))
    return counted.filter((F.col("_bad") == 0) & (F.col("_seen") == F.col("page")) & within).select("source_name", "page", "attempt")


def discover_api(attempts: DataFrame, sources: DataFrame, limit: int | None = None) -> DataFrame:
    """Articles of landed API answers; a source ends at its first failed or empty page.

    ``attempts`` has ``source_name, page, attempt, http_status, payload``; pages count from 1 and a missing
    page number ends the source like a failed one. Which pages count is decided on rows without payload, held in
    an intermediate table; a payload is read twice and shuffled once, by page.
    """
    config = bounded_broadcast(sources.select(F.lower("source_name").alias("_c"), "data_path", "field_mapping", "max_pages"))
    landed = attempts.join(config, F.lower("source_name") == F.col("_c"), "left").drop("_c")
    key = ["source_name", "page", "attempt"]
    found = let(F.try_parse_json("payload"), lambda d: _items(d, F.col("data_path")))
    answers = landed.filter(classify_attempt("http_status") == "parse")
    sizes = answers.select(*key, "max_pages", F.size(found).alias("n_items"))
    settled = decisive_attempts(attempts.select(*key, "http_status")).join(sizes, key, "left")
    wanted = _open_pages(materialize(settled))
    items = answers.select(*key, "data_path", "field_mapping", "payload").join(wanted, key).select(
        "source_name", "page", "field_mapping",
        F.posexplode(F.transform(found, lambda i: F.to_json(i))).alias("item_pos", "raw_metadata"),
    ).withColumn("i", F.try_parse_json("raw_metadata"))
    i, mapping = F.col("i"), F.col("field_mapping")
    keyed = (
        items.filter(F.schema_of_variant(i).startswith("OBJECT"))
        .withColumn("_raw_url", _api_url(i, mapping))
        .filter(T.blank_to_null("_raw_url").isNotNull())
        .withColumn("url", U.normalize_v1("_raw_url"))
        .select("source_name", "page", "item_pos", "field_mapping", "url", "raw_metadata")
    )
    unique = _finish(keyed, ["page", "item_pos"], limit).withColumn("_item", F.try_parse_json("raw_metadata"))
    item = F.col("_item")
    return unique.select(
        "source_name", "url",
        *[api_field(item, mapping, f).alias(f) for f in ["title", "published_at", "summary", "author", "thumbnail_url"]],
        F.lit("api").alias("discovery_method"), "raw_metadata", "position",
    )


def _anchors(pages: DataFrame, keep: list[str]) -> DataFrame:
    return pages.select(*keep, F.explode(dom.page_links(F.col("_page"))).alias("a")).select(*keep, F.col("a.pos").alias("node_pos"), "a")


MIN_LINK_TEXT = 10


def discover_listing(listings: DataFrame, sources: DataFrame, limit: int | None = None) -> DataFrame:
    """Article links of landed listing pages: ``source_name, listing_pos, listing_url, http_status, html``."""
    config = bounded_broadcast(sources.select(F.lower("source_name").alias("_c"), "domains"))
    answered = listings.filter(F.col("http_status").isNull() | (F.col("http_status") < 400))
    anchors = _anchors(answered.withColumn("_page", dom.parse_page("html")), ["source_name", "listing_pos", "listing_url"])
    keyed = anchors.withColumn("url", U.normalize_v1(U.url_join("listing_url", "a.href")))
    articles = keyed.join(config, F.lower("source_name") == F.col("_c")).filter(U.is_article_link("url", F.col("domains")))
    title = F.when(F.char_length("a.text") >= MIN_LINK_TEXT, F.col("a.text")).otherwise(F.col("a.title"))
    none = F.lit(None).cast("string")
    return _finish(articles, ["listing_pos", "node_pos"], limit).select(
        "source_name", "url", title.alias("title"), none.alias("published_at"), none.alias("summary"), none.alias("author"),
        none.alias("thumbnail_url"), F.lit("listing").alias("discovery_method"),
        F.to_json(F.struct(F.col("listing_url").alias("listing_source"))).alias("raw_metadata"), "position",
    )


def discover_homepage(homepages: DataFrame, domain: Column | str, limit: int | None = None) -> DataFrame:
    """Older variant: links of the site itself that end in ``.html``. ``homepages`` has ``source_name, home_url, html``."""
    anchors = _anchors(homepages.withColumn("_page", dom.parse_page("html")), ["source_name", "home_url"])
    domain_name = F.lit(domain) if isinstance(domain, str) else domain
    keyed = anchors.withColumn("url", U.normalize_v1(U.url_join("home_url", "a.href")))
    # Subdomains count; the comparison is case-sensitive and so is the suffix.
    own = (U.netloc("url") == domain_name) | F.endswith(U.netloc("url"), F.concat(F.lit("."), domain_name))
    found = keyed.filter(own & U.path("url").endswith(".html"))
    return _finish(found, ["node_pos"], limit).select("source_name", "url", "position")


def route_collector(sources: DataFrame) -> DataFrame:
    """Which kind of discovery each source gets."""
    return sources.withColumn(
        "collector",
        F.when((F.col("channel_type") == "rss") | (F.coalesce(F.size("rss_feeds"), F.lit(0)) > 0), F.lit("rss"))
        .when((F.col("channel_type") == "api") | F.col("api_url").isNotNull(), F.lit("api"))
        .otherwise(F.lit("listing")),
    )


def select_sources(sources: DataFrame, name: str | None = None, channel_type: str = "all", everything: bool = False) -> DataFrame:
    """A named source, or all of them, or those of a channel type."""
    if name:
        return sources.filter(F.lower("source_name") == name.lower().strip())
    if everything or channel_type == "all":
        return sources
    return sources.filter(F.col("channel_type") == channel_type)


def dry_run_listing(discovered: DataFrame, limit: int = 10) -> DataFrame:
    """Numbered preview of the first ``limit`` finds per source; of all with a limit of 0."""
    if limit and limit <= GROUP_LIMIT:
        numbered = discovered.withColumn("line", F.row_number().over(W.partitionBy("source_name").orderBy("position")).cast("bigint"))
        numbered = numbered.filter(F.col("line") <= limit)
    else:  # a whole source is counted in pieces, not sorted in one task
        cut = balanced_buckets(discovered, ["source_name"], ["position"])
        numbered = running(cut, ["source_name"], ["_bucket"], ["position"], {"line": ("sum", F.lit(1).cast("bigint"))})
        numbered = numbered.filter(F.col("line") <= limit) if limit else numbered
    summary = T.blank_to_null("summary")
    return numbered.select(
        "source_name",
        "line",
        T.text_or("published_at", T.NO_DATE).alias("published_at"),
        T.text_or("title", T.NO_TITLE).alias("title"),
        "url",
        F.when(summary.isNotNull(), F.concat(F.substring(summary, 1, 120), F.lit("..."))).alias("summary"),
    )


def parse_url_list(lists: DataFrame, list_id: str, urls: str) -> tuple[DataFrame, DataFrame]:
    """Comma-separated URL lists as (accepted, rejected): canonical URLs in first-seen order, and bad entries as text."""
    entries = lists.select(list_id, F.posexplode(F.split(urls, ",")).alias("entry_pos", "_raw")).withColumn(
        "raw_url", U.strip_blanks("_raw")).filter(F.col("raw_url") != "").drop("_raw")
    checked = entries.withColumn("url", U.normalize_v2("raw_url"))
    accepted = dedupe_first_wins(checked.filter(F.col("url").isNotNull()), ["entry_pos"], source=list_id)
    return accepted.select(list_id, "entry_pos", "url"), checked.filter(F.col("url").isNull()).select(list_id, "entry_pos", "raw_url")
