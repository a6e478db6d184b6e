"""Table contracts."""

from __future__ import annotations

SOURCES = (
    "source_id bigint, source_name string, display_name string, channel_type string, domains array<string>, "
    "rss_feeds array<string>, api_url string, data_path string, field_mapping map<string,string>, "
    "paging_type string, page_size int, max_pages int, rate_limit_delay double, listing_urls array<string>, "
    "fetcher_type string, fetcher_timeout int, config_order int"
)
SOURCE_RULES = "source_name string, field string, priority int, selector string"

FEED_PAYLOADS = "source_name string, feed_pos int, feed_url string, http_status int, payload string"
API_ATTEMPTS = "source_name string, page int, attempt int, http_status int, payload string"
LISTING_PAGES = "source_name string, listing_pos int, listing_url string, http_status int, html string"
FETCHED_PAGES = (
    "source_name string, url string, final_url string, html string, http_status int, fetch_method string, error_kind string, "
    "error string, fetched_at timestamp"
)

DISCOVERED = (
    "source_name string, url string, title string, published_at string, summary string, author string, "
    "thumbnail_url string, discovery_method string, raw_metadata string, position array<bigint>"
)

ARTICLES = (
    "url string, title string, author string, published_at string, content string, thumbnail_url string, "
    "canonical_url string, quality_flags array<string>"
)

# Keys of metadata version 2, in contract order.
METADATA_V2_FIELDS = [
    "schema_version", "source", "url", "final_url", "title", "author", "published_at", "content",
    "thumbnail_url", "raw_object_key", "raw_payload_type", "raw_content_hash", "status", "http_status",
    "crawl_run_id", "fetched_at",
]

RAWDATA = (
    "id bigint, source_id bigint, url string, final_url string, http_status int, raw_object_key string, "
    "raw_payload_type string, raw_content_hash string, crawl_run_id string, status string, error_type string, "
    "error_message string, fetched_at timestamp, created_at timestamp"
)
RAWDATA_COLUMNS = [part.split()[0] for part in RAWDATA.split(", ")]
