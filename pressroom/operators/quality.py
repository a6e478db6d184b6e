"""Crawl status, quality flags and metadata validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.functions.text import blank_to_null
from pressroom.functions.urls import col, let
from pressroom.schemas import METADATA_V2_FIELDS
from pressroom.session import bounded_broadcast

SHORT_CONTENT = 150

# Message texts of the outcome record.
EMPTY_HTML_ERROR = "Nội dung HTML trả về bị rỗng"
NO_CONTENT_ERROR = "Không tìm thấy nội dung bài viết phù hợp"


def is_blank(text: Column | str) -> Column:
    return F.coalesce(~col(text).rlike(r"(?U)[^\s]"), F.lit(True))


def quality_flags(title="title", author="author", published_at="published_at", content="content") -> Column:
    """Names of what an article lacks, in fixed order."""

    def missing(field, flag: str) -> Column:
        return F.when(blank_to_null(field).isNull(), F.lit(flag))

    short = F.when(F.char_length(col(content)).between(1, SHORT_CONTENT - 1), F.lit("short_content"))
    return F.array_compact(
        F.array(
            missing(title, "missing_title"),
            missing(author, "missing_author"),
            missing(published_at, "missing_published_at"),
            missing(content, "missing_content"),
            short,
        )
    )


def crawl_status(html: Column | str, content: Column | str, error_kind: Column | str | None = None) -> Column:
    """Outcome of one fetch. The HTTP status plays no part: a 404 page with paragraphs is a success."""
    by_page = (
        F.when(is_blank(html), F.lit("EMPTY_HTML"))
        .when(blank_to_null(content).isNotNull(), F.lit("SUCCESS"))
        .otherwise(F.lit("CONTENT_NOT_FOUND"))
    )
    if error_kind is None:
        return by_page
    kind = F.lower(col(error_kind))
    return (
        F.when(kind == "timeout", F.lit("TIMEOUT"))
        .when(kind == "blocked", F.lit("BLOCKED"))
        .when(blank_to_null(error_kind).isNotNull(), F.lit("UNKNOWN_ERROR"))
        .otherwise(by_page)
    )


def status_error(status: Column | str, error: Column | str | None = None) -> Column:
    """Error text that goes with a status."""
    default = F.when(col(status) == "EMPTY_HTML", F.lit(EMPTY_HTML_ERROR)).when(
        col(status) == "CONTENT_NOT_FOUND", F.lit(NO_CONTENT_ERROR)
    )
    if error is None:
        return default
    return F.coalesce(default, F.when(col(status) != "SUCCESS", col(error)))


def fetch_strategy(http_pages: DataFrame, rendered_pages: DataFrame, fetcher_type: str = "fetcher_type") -> DataFrame:
    """Use the browser copy where the plain response was blank or forbidden.

    ``http_status`` keeps the plain response's value; ``fetch_method`` tells which copy was used.
    """
    needs_copy = (is_blank("html") | F.coalesce(F.col("http_status") == 403, F.lit(False))) & (F.col(fetcher_type) == "http")
    marked = http_pages.withColumn("needs_browser", F.coalesce(needs_copy, F.lit(False)))
    # Only the few pages that want a copy are joined; copies are cut to their URLs first, and to one a URL.
    few = marked.where("needs_browser")
    wanted = rendered_pages.join(bounded_broadcast(few.select("url").distinct()), "url", "left_semi").where(~is_blank("html"))
    copies = wanted.groupBy("url").agg(F.min(F.struct("html", "final_url")).alias("_copy"))
    copies = copies.select("url", F.col("_copy.html").alias("_html"), F.col("_copy.final_url").alias("_final"))
    none = F.lit(None).cast("string")
    rest = marked.where("not needs_browser").withColumns({"_html": none, "_final": none})
    joined = few.join(copies, "url", "left").unionByName(rest)
    use_copy = F.col("needs_browser") & F.col("_html").isNotNull()
    return joined.select(
        *[c for c in http_pages.columns if c not in ("html", "final_url")],
        F.when(use_copy, F.col("_html")).otherwise(F.col("html")).alias("html"),
        F.coalesce(F.when(use_copy, blank_to_null("_final")), blank_to_null("final_url"), F.col("url")).alias("final_url"),
        "needs_browser",
        F.when(use_copy, F.lit("browser")).otherwise(F.lit("http")).alias("fetch_method"),
    )


def _kind(document: Column, field: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(document, f"$.{field}", "variant"))


def _text(document: Column, field: str) -> Column:
    return F.try_variant_get(document, f"$.{field}", "string")


def _with_document(json: Column | str, body) -> Column:
    """Bind the parsed document and the keys of a JSON text, so each is computed once per row.

    The keys come from the text: a typed reader could not tell a null value from a missing key.
    """
    parsed = F.struct(F.try_parse_json(col(json)).alias("document"), F.json_object_keys(col(json)).alias("keys"))
    return let(parsed, lambda p: body(p["document"], p["keys"]))


def _version(document: Column, keys: Column) -> Column:
    # Only a number can declare the version; text "2" does not.
    declared = F.when(
        let(_kind(document, "schema_version"), lambda k: k.isin("BIGINT", "DOUBLE") | k.startswith("DECIMAL")),
        F.try_variant_get(document, "$.schema_version", "double") == 2,
    )
    return (
        F.when(declared, F.lit(2))
        .when(F.array_contains(keys, "raw_html_path") | F.array_contains(keys, "crawl_status"), F.lit(1))
        .cast("int")
    )


def metadata_version(json: Column | str) -> Column:
    """2 when declared, 1 when a legacy key is present, null otherwise. Works on the raw JSON text."""
    return _with_document(json, _version)


def metadata_error(json: Column | str, allow_legacy: bool = False) -> Column:
    """First broken rule of the metadata contract, null when the document is valid."""
    required = F.array(*[F.lit(f) for f in METADATA_V2_FIELDS])

    def check(document: Column, keys: Column) -> Column:
        def no_text(field: str) -> Column:
            return ~F.coalesce((_kind(document, field) == "STRING") & (_text(document, field) != ""), F.lit(False))

        def of_version_2(missing: Column) -> Column:
            return (
                F.when(F.size(missing) > 0, F.concat(F.lit("Metadata v2 is missing fields: "), F.array_join(missing, ", ")))
                .when(no_text("source"), F.lit("Metadata source must be a non-empty string"))
                .when(no_text("url"), F.lit("Metadata url must be a non-empty string"))
                .when(no_text("status"), F.lit("Metadata status must be a non-empty string"))
                .when(no_text("fetched_at"), F.lit("Metadata fetched_at must be an ISO timestamp"))
                .when(~_kind(document, "http_status").isin("BIGINT", "VOID"), F.lit("Metadata http_status must be an integer or null"))
            )

        legacy = F.lit(None).cast("string") if allow_legacy else F.lit("Legacy metadata v1 requires allow_legacy=True")
        return let(
            _version(document, keys),
            lambda v: F.when(v == 1, legacy).when(v == 2, let(F.array_except(required, keys), of_version_2))
            .otherwise(F.lit("Metadata must declare schema_version=2")),
        )

    return _with_document(json, check)


def validate_metadata(documents: DataFrame, json: str = "json", allow_legacy: bool = False) -> DataFrame:
    """Add ``schema_version`` and ``validation_error``; nothing is raised and no row is dropped."""
    return documents.withColumns(
        {"schema_version": metadata_version(json), "validation_error": metadata_error(json, allow_legacy)}
    )


def compatible_view(documents: DataFrame, json: str = "json") -> DataFrame:
    """Read both metadata generations through the names of version 2."""
    plain = ["source", "url", "final_url", "title", "author", "published_at", "content", "thumbnail_url",
             "raw_payload_type", "raw_content_hash", "crawl_run_id", "error_type", "fetched_at"]
    either = {"raw_object_key": "raw_html_path", "status": "crawl_status", "error_message": "error"}

    def fields(document: Column, keys: Column) -> Column:
        return F.struct(
            _version(document, keys).alias("schema_version"),
            *[_text(document, f).alias(f) for f in plain],
            *[F.coalesce(blank_to_null(_text(document, new)), blank_to_null(_text(document, old))).alias(new) for new, old in either.items()],
            F.try_variant_get(document, "$.http_status", "int").alias("http_status"),
        )

    kept = [c for c in documents.columns if c not in {*plain, *either, "schema_version", "http_status"}]
    return documents.withColumn("_m", _with_document(json, fields)).select(*kept, "_m.*")
