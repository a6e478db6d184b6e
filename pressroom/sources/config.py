"""Source configuration as tables: sources and their extraction rules."""

from __future__ import annotations

from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from pressroom.operators.dedupe import pick_first
from pressroom.schemas import SOURCE_RULES, SOURCES

# Rules of a source that configures none.
DEFAULT_SELECTORS = {
    "title": ["h1", "meta[property='og:title']@content"],
    "author": [],
    "published_at": ["meta[property='article:published_time']@content", "time[datetime]@datetime"],
    "thumbnail_url": ["meta[property='og:image']@content"],
    "content_paragraphs": [".fck_detail p", "article p", ".content p"],
    "strip": ["script", "style", ".ads", ".banner"],
}

# The older rules for one site, without stripping and without JSON-LD.
LEGACY_SELECTORS = {
    "title": ["h1.title-detail", "h1", "title"],
    "author": [".author_mail", ".author"],
    "published_at": ["meta[property='article:published_time']@content", "time[datetime]", ".date"],
    "thumbnail_url": ["meta[property='og:image']@content"],
    "content_paragraphs": [".fck_detail p", "article p", ".content_detail p"],
    "strip": [],
}

# The configured sources.
SOURCE_CONFIGS: list[dict[str, Any]] = [
    {
        "source_id": 1, "source_name": "vnexpress", "display_name": "VnExpress", "channel_type": "rss",
        "domains": ["vnexpress.net"],
        "rss_feeds": ["https://vnexpress.net/rss/khoa-hoc-cong-nghe.rss"],
        "listing_urls": ["https://vnexpress.net/so-hoa/cong-nghe"],
        "fetcher_type": "http", "fetcher_timeout": 20,
        "selectors": {
            "title": ["h1.title-detail", "h1.title_news_detail", "h1", "meta[property='og:title']@content"],
            "author": [".author_mail", ".author", "p.Normal strong"],
            "published_at": ["meta[property='article:published_time']@content", "time[datetime]@datetime",
                             "time.date[datetime]@datetime", ".date"],
            "thumbnail_url": ["meta[property='og:image']@content", "article img@src"],
            "content_paragraphs": [".fck_detail p", "article p", ".content_detail p"],
            "strip": [".box-common-category", ".list-news-related", ".box-interact", "script", "style"],
        },
    },
    {
        "source_id": 2, "source_name": "cafef", "display_name": "CafeF", "channel_type": "rss",
        "domains": ["cafef.vn"],
        "rss_feeds": ["https://cafef.vn/tin-moi.rss", "https://cafef.vn/thi-truong-chung-khoan.rss"],
        "listing_urls": ["https://cafef.vn/thi-truong.chn"],
        "fetcher_type": "http", "fetcher_timeout": 15,
        "selectors": {
            "title": ["h1.title", "h1.title-detail", "h1", "meta[property='og:title']@content"],
            "author": [".author", ".author-info", "span.author"],
            "published_at": ["meta[property='article:published_time']@content", "time[datetime]@datetime", ".date-time", ".date"],
            "thumbnail_url": ["meta[property='og:image']@content", "meta[name='twitter:image']@content"],
            "content_paragraphs": [".detail-content p", ".content p", "article p"],
            "strip": [".link-content-footer", ".box-tag", "script", "style"],
        },
    },
    {
        "source_id": 3, "source_name": "techcrunch", "display_name": "TechCrunch", "channel_type": "rss",
        "domains": ["techcrunch.com"],
        "rss_feeds": ["https://techcrunch.com/feed/", "https://techcrunch.com/category/artificial-intelligence/feed/"],
        "listing_urls": ["https://techcrunch.com/category/artificial-intelligence/"],
        "fetcher_type": "http", "fetcher_timeout": 15,
        "selectors": {
            "title": ["h1.article__title", "h1.wp-block-post-title", "h1", "meta[property='og:title']@content"],
            "author": [".article__byline a", ".wp-block-post-author-name", "meta[name='author']@content"],
            "published_at": ["meta[property='article:published_time']@content", "time[datetime]@datetime", ".article__date"],
            "thumbnail_url": ["meta[property='og:image']@content", "figure.article__featured-image img@src"],
            "content_paragraphs": [".article-content p", ".entry-content p", "article p"],
            "strip": [".wp-block-embed", "script", "style"],
        },
    },
    {
        "source_id": 101, "source_name": "devto", "display_name": "DEV Community (AI News)", "channel_type": "api",
        "domains": ["dev.to"],
        "api_url": "https://dev.to/api/articles",
        "field_mapping": {"url": "url", "title": "title", "published_at": "published_at", "summary": "description",
                          "author": "user.name", "thumbnail_url": "cover_image"},
        "max_pages": 1, "rate_limit_delay": 1.0,
        "fetcher_type": "http", "fetcher_timeout": 15,
        "selectors": {
            "title": ["h1", "meta[property='og:title']@content"],
            "author": ["a.crayons-link--secondary.fw-bold", "meta[name='author']@content"],
            "published_at": ["meta[property='article:published_time']@content", "time[datetime]@datetime"],
            "thumbnail_url": ["meta[property='og:image']@content"],
            "content_paragraphs": ["#article-body p", ".crayons-article__body p", "article p"],
            "strip": [".actions", "script", "style"],
        },
    },
    {
        "source_id": 201, "source_name": "vietnamnet", "display_name": "VietNamNet (Công Nghệ)", "channel_type": "html",
        "domains": ["vietnamnet.vn"],
        "listing_urls": ["https://vietnamnet.vn/thong-tin-truyen-thong"],
        "fetcher_type": "http", "fetcher_timeout": 15,
        "selectors": {
            "title": ["h1.content-detail-title", "h1", "meta[property='og:title']@content"],
            "author": [".author-name", ".article-author"],
            "published_at": ["meta[property='article:published_time']@content", ".bread-crumb-detail__time"],
            "thumbnail_url": ["meta[property='og:image']@content"],
            "content_paragraphs": ["#maincontent p", ".maincontent p", "article p"],
            "strip": [".inner-article", ".article-relate", "script", "style"],
        },
    },
]

CHANNEL_TYPES = ["rss", "api", "html"]


def small_table(spark: SparkSession, rows: list[dict[str, Any]], ddl: str) -> DataFrame:
    """A driver-side configuration table whose size the optimizer knows."""
    schema = _parse_datatype_string(ddl)
    columns = {f.name: [row.get(f.name) for row in rows] for f in schema.fields}
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    table = pa.table({f.name: pa.array(
        [list(v.items()) if isinstance(v, dict) else v for v in columns[f.name]], type=f.type) for f in arrow}, schema=arrow)
    return spark.createDataFrame(table, schema=schema)


def builtin_sources(spark: SparkSession) -> DataFrame:
    return small_table(spark, [{**c, "config_order": i} for i, c in enumerate(SOURCE_CONFIGS)], SOURCES)


def rules_table(spark: SparkSession, selectors: dict[str, dict[str, list[str]]]) -> DataFrame:
    """One row per rule from ``{source_name: {field: [selector, ...]}}``."""
    rows = [
        {"source_name": name, "field": field, "priority": i, "selector": selector}
        for name, fields in selectors.items() for field, listed in fields.items() for i, selector in enumerate(listed)
    ]
    return small_table(spark, rows, SOURCE_RULES)


def builtin_rules(spark: SparkSession) -> DataFrame:
    """Rules of the configured sources and of the generic fallback."""
    return rules_table(spark, {"generic": DEFAULT_SELECTORS, **{c["source_name"]: c["selectors"] for c in SOURCE_CONFIGS}})


def sources_table(configs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) sources. The last of equal names wins; an unusable config is set aside, not fatal."""
    usable = (
        F.col("source_id").isNotNull() & F.col("source_name").isNotNull()
        & F.coalesce(F.col("channel_type").isin(CHANNEL_TYPES), F.lit(False))
    )
    flagged = configs.withColumn("_usable", usable)
    accepted = pick_first(flagged.filter("_usable"), [F.lower("source_name")], [F.col("config_order").desc()]).drop("_usable")
    return accepted, flagged.filter(~F.col("_usable")).drop("_usable")


def rules_from_lists(configs: DataFrame, name: str = "source_name", fields: dict[str, str] | None = None) -> DataFrame:
    """Rule rows from array columns, list position as priority. ``fields`` maps field name to column."""
    fields = fields or {f: f for f in DEFAULT_SELECTORS}
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(c).alias("selectors")) for f, c in fields.items()])
    return configs.select(F.col(name).alias("source_name"), F.explode(pairs).alias("p")).select(
        "source_name", "p.field", F.posexplode("p.selectors").alias("priority", "selector"))
