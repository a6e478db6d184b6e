"""Run ids and object keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressroom.functions.urls import col, safe_source_name, url_hash_v1

# Fixed value: the URL namespace of RFC 4122.
URL_NAMESPACE_HEX = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5_url(name: Column) -> Column:
    """Name-based UUID (version 5) in the URL namespace, without leaving the JVM."""
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE_HEX)), name.cast("binary")))
    variant = F.conv(F.substring(digest, 17, 2), 16, 10).cast("int").bitwiseAND(63).bitwiseOR(128)
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(F.lower(F.hex(variant)), F.substring(digest, 19, 2)),
        F.substring(digest, 21, 12),
    )


def stable_run_id(dag_id: Column | str, scheduler_run_id: Column | str) -> Column:
    """The same run id for every retry of one scheduled run."""
    return uuid5_url(F.concat(F.lit("airflow://"), col(dag_id), F.lit("/"), col(scheduler_run_id)))


def date_path(fetched_at: Column | str, zone: str = "UTC") -> Column:
    """``yyyy/MM/dd`` of an instant seen in ``zone``; the session zone must be UTC."""
    return F.date_format(F.from_utc_timestamp(col(fetched_at), zone), "yyyy/MM/dd")


def crawl_id(url: Column | str, fetched_at: Column | str) -> Column:
    return F.concat_ws("_", url_hash_v1(url), F.date_format(col(fetched_at), "HHmmss"), F.date_format(col(fetched_at), "SSSSSS"))


def raw_object_key(source: Column | str, url: Column | str, fetched_at: Column | str, zone: str = "UTC") -> Column:
    return F.concat(F.lit("crawl_data/raw/"), safe_source_name(source), F.lit("/"), date_path(fetched_at, zone),
                    F.lit("/"), crawl_id(url, fetched_at), F.lit(".html.gz"))


def metadata_object_key(source: Column | str, url: Column | str, fetched_at: Column | str, zone: str = "UTC") -> Column:
    return F.concat(F.lit("crawl_data/metadata/"), safe_source_name(source), F.lit("/"), date_path(fetched_at, zone),
                    F.lit("/"), crawl_id(url, fetched_at), F.lit(".json"))


def content_addressed_key(source: Column | str, payload_hash: Column | str, fetched_at: Column | str, zone: str = "UTC") -> Column:
    """Key derived from the payload itself, so equal payloads of a day share one object."""
    return F.concat(F.lit("raw/"), safe_source_name(source), F.lit("/"), date_path(fetched_at, zone),
                    F.lit("/"), col(payload_hash), F.lit(".html.gz"))
