"""Source lookup, duplicates, skip lists and idempotent writes.

First-wins and last-wins picks are ``row_number() = 1`` filters: Spark keeps one row per group and
map task before the shuffle, so a group holding a third of all rows stays harmless.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pressroom.functions import urls as U
from pressroom.functions.text import blank_to_null
from pressroom.operators.running import balanced_buckets, positions, running
from pressroom.schemas import RAWDATA_COLUMNS
from pressroom.session import bounded_broadcast, materialize


def pick_first(df: DataFrame, keys: list, order: list, n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group in the given order. Keys and order may be columns or names."""
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


# Up to this n, Spark keeps the first n rows of a group in every map task (its default threshold).
GROUP_LIMIT = 1000


def limit_per_source(df: DataFrame, order: list[str], limit: int | None, source: str = "source_name") -> DataFrame:
    """At most ``limit`` rows per source; 0 or None means no limit.

    A limit too large to be applied before the shuffle is counted in buckets, not by sorting a whole source.
    """
    if not limit:
        return df
    if limit <= GROUP_LIMIT:
        return pick_first(df, [source], order, limit)
    cut = balanced_buckets(df, [source], order)
    counted = running(cut, [source], ["_bucket"], order, {"_n": ("sum", F.lit(1).cast("bigint"))})
    return counted.filter(F.col("_n") <= limit).drop("_n", "_bucket")


def source_domains(sources: DataFrame) -> DataFrame:
    """Domain lookup: one row per domain. A repeated domain keeps its first place in the lookup
    order but belongs to the last source that names it."""
    listed = sources.select(
        F.lower("source_name").alias("rule_set"), "source_id", "source_name", "config_order",
        F.posexplode("domains").alias("domain_pos", "domain"),
    ).withColumn("domain", F.lower(F.trim("domain")))
    place = F.struct("config_order", "domain_pos")
    return listed.groupBy("domain").agg(
        F.min(place).alias("lookup_order"),
        F.max_by(F.struct("rule_set", "source_id", "source_name"), place).alias("config"),
    )


IN_ROW_DOMAINS = 1000
_CONFIG = "struct<lookup_order:struct<config_order:int,domain_pos:int>,config:struct<rule_set:string,source_id:bigint,source_name:string>>"


def _config_in_row(df: DataFrame, entries: list[Row]) -> DataFrame:
    """Look the suffixes of each host up in a constant map of the configured domains; no row moves."""
    as_json = json.dumps({e["domain"]: e.asDict(recursive=True) for e in entries})
    lookup = F.from_json(F.lit(as_json), f"map<string,{_CONFIG}>")
    hits = F.transform(U.host_suffixes("_host"), lambda s: F.try_element_at(lookup, s))
    return df.withColumn("_config", F.array_min(hits)["config"])


def _config_by_join(df: DataFrame, domains: DataFrame) -> DataFrame:
    """For a domain list too long for a map: match each distinct host once, then join the matches."""
    hosts = df.select("_host").distinct().select("_host", F.explode(U.host_suffixes("_host")).alias("_suffix"))
    matched = (
        hosts.join(domains, F.col("_suffix") == F.col("domain"))
        .groupBy(F.col("_host").alias("_h_host"))
        .agg(F.min_by("config", "lookup_order").alias("_config"))
    )
    return df.join(matched, F.col("_host") == F.col("_h_host"), "left").drop("_h_host")


def resolve_source(
    df: DataFrame, sources: DataFrame, url: str = "url", named: str | None = None, in_row_domains: int = IN_ROW_DOMAINS
) -> DataFrame:
    """Add ``rule_set``, ``source_id`` and ``source_name``: by name, else by domain, else generic.

    The suffix match never compares every host with every domain: a host is expanded to its
    dot-suffixes and those are looked up by equality.
    """
    given = blank_to_null(F.lower(F.trim(F.col(named)))) if named else F.lit(None).cast("string")
    base = df.drop("rule_set", "source_id", *([] if named == "source_name" else ["source_name"]))
    base = base.withColumns({"_given": given, "_host": F.lower(F.trim(U.netloc(url)))})
    if named:
        by_name = bounded_broadcast(sources.select(
            F.lower("source_name").alias("_n_key"), F.col("source_id").alias("_n_id"), F.col("source_name").alias("_n_name")))
        base = base.join(by_name, F.col("_given") == F.col("_n_key"), "left")
    else:
        base = base.withColumns({"_n_key": F.lit(None).cast("string"), "_n_id": F.lit(None).cast("bigint"),
                                 "_n_name": F.lit(None).cast("string")})
    domains = source_domains(sources)
    entries = domains.limit(in_row_domains + 1).collect()
    found = _config_in_row(base, entries) if len(entries) <= in_row_domains else _config_by_join(base, domains)
    inferred = U.infer_source_name(url)
    if named:
        inferred = F.coalesce(blank_to_null(F.col(named)), inferred)
    return found.select(
        *[c for c in df.columns if c not in ("rule_set", "source_id", "source_name")],
        F.coalesce("_n_key", "_config.rule_set", F.lit(U.GENERIC_SOURCE_NAME)).alias("rule_set"),
        F.coalesce("_n_id", "_config.source_id", F.lit(U.GENERIC_SOURCE_ID)).cast("bigint").alias("source_id"),
        F.coalesce("_n_name", "_config.source_name", inferred).alias("source_name"),
    )


def dedupe_first_wins(df: DataFrame, order: list, url: str = "url", source: str = "source_name") -> DataFrame:
    """One row per URL and source: the earliest by an explicit order."""
    return pick_first(df, [source, url], order)


def latest_artifact(artifacts: DataFrame, keys: list[str], modified: str = "modified_at", tie: str = "metadata_path") -> DataFrame:
    """Newest artifact per key; equal times are settled by path."""
    return pick_first(artifacts, keys, [F.col(modified).desc(), F.col(tie).desc()])


def skip_any_artifact(candidates: DataFrame, artifacts: DataFrame, force: bool = False) -> DataFrame:
    """Drop candidates that have any earlier artifact, a failed one included.

    Candidates carry ``source_name`` and ``url_hash``; artifacts carry ``source_name``, ``url_hash``,
    ``modified_at``, ``metadata_path`` and ``readable``. A source with artifacts of its own is checked
    against those only, a source without any against all. An unreadable newest artifact is as good as none.
    """
    if force:
        return candidates
    a = artifacts.select("source_name", "url_hash", "modified_at", "metadata_path", "readable")
    known_sources = bounded_broadcast(a.select(F.col("source_name").alias("_s")).distinct())
    own = latest_artifact(a, ["source_name", "url_hash"]).filter("readable").select(
        F.col("source_name").alias("_a_source"), F.col("url_hash").alias("_a_hash"))
    anywhere = latest_artifact(a, ["url_hash"]).filter("readable").select(
        F.lit(None).cast("string").alias("_a_source"), F.col("url_hash").alias("_a_hash"))
    # One anti-join serves both scopes: the null source stands for "all sources".
    scoped = candidates.join(known_sources, F.col("source_name") == F.col("_s"), "left")
    return scoped.join(
        own.unionByName(anywhere), (F.col("url_hash") == F.col("_a_hash")) & F.col("_s").eqNullSafe(F.col("_a_source")), "left_anti"
    ).drop("_s")


def known_success(rawdata: DataFrame, keys: list[str]) -> DataFrame:
    return rawdata.filter(F.col("status") == "SUCCESS").select(*keys)


def url_exists(candidates: DataFrame, rawdata: DataFrame, per_source: bool = False) -> DataFrame:
    """Candidates already crawled with success."""
    keys = ["url", "source_id"] if per_source else ["url"]
    return candidates.join(known_success(rawdata, keys), keys, "left_semi")


def url_missing(candidates: DataFrame, rawdata: DataFrame, per_source: bool = False) -> DataFrame:
    """Candidates without a successful row; earlier failures do not count."""
    keys = ["url", "source_id"] if per_source else ["url"]
    return candidates.join(known_success(rawdata, keys), keys, "left_anti")


def skip_done_in_run(candidates: DataFrame, rawdata: DataFrame) -> DataFrame:
    """Mark candidates of a run as ``SKIPPED_EXISTING`` (with the existing id) or ``PENDING``.

    Keys are ``source_id``, ``crawl_run_id`` and ``url``; of several rows the lowest id is reported.
    """
    keys = ["source_id", "crawl_run_id", "url"]
    done = rawdata.filter(F.col("status") == "SUCCESS").groupBy(*keys).agg(
        F.min("id").alias("existing_id"), F.lit(True).alias("_done"))
    return candidates.join(done, keys, "left").withColumn(
        "action", F.when(F.col("_done"), F.lit("SKIPPED_EXISTING")).otherwise(F.lit("PENDING"))
    ).drop("_done")


RUN_KEY = ["source_id", "crawl_run_id", "url"]


def upsert_rawdata(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Same (source, run, url): the lowest id stays, the newest state wins, ``created_at`` is kept.

    Incoming rows may have a null id; a key that has none yet comes out with a null id for
    ``assign_ids``. Equal fetch times are won by the incoming row. Replaying a batch changes nothing.
    """
    columns = [c for c in RAWDATA_COLUMNS if c in existing.columns]
    both = existing.select(*columns, F.lit(0).alias("_new")).unionByName(incoming.select(*columns, F.lit(1).alias("_new")))
    state = F.struct(*[c for c in columns if c not in RUN_KEY + ["id", "created_at"]])
    recency = F.struct("fetched_at", "_new", state.alias("state"))
    merged = both.groupBy(*RUN_KEY).agg(
        F.min("id").alias("id"), F.min("created_at").alias("created_at"), F.max_by(state, recency).alias("_state")
    )
    return merged.select(
        *[F.col(c) if c in RUN_KEY + ["id", "created_at"] else F.col(f"_state.{c}").alias(c) for c in columns]
    )


def assign_ids(rows: DataFrame, start_after: int | Column, order: str = "fetched_at") -> DataFrame:
    """Give rows without an id consecutive numbers, the same on every replay.

    Numbers follow ``order``, then the key. Rows are numbered range by range, so no single task sees all of them, nor a total for each moment.
    """
    fresh = rows.filter(F.col("id").isNull())
    start = F.lit(start_after) if isinstance(start_after, int) else start_after
    given = positions(fresh, [order, *RUN_KEY]).withColumn("id", (start + F.col("_n")).cast("bigint")).select(*rows.columns)
    return rows.filter(F.col("id").isNotNull()).unionByName(given)


def first_bodies(rows: DataFrame, keys: list[str], order: list[str], among: DataFrame | None = None) -> DataFrame:
    """The first row per key, bodies and all. Which one it is, is told on keys and order columns (of ``among``, else of all rows); only then is its
    body fetched, once."""
    first = (rows if among is None else among).groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"))
    named = {c: f"_w{i}" for i, c in enumerate([*keys, *order])}
    wanted = first.select(*[F.col(k).alias(named[k]) for k in keys], *[F.col(f"_first.{c}").alias(named[c]) for c in order])
    same = None
    for c, w in named.items():
        test = F.col(c).eqNullSafe(F.col(w))
        same = test if same is None else same & test
    # rows that are equal in keys and order are copies of each other
    return rows.join(bounded_broadcast(materialize(wanted)), same, "left_semi").dropDuplicates(keys)


def immutable_first_write(existing_keys: DataFrame, payloads: DataFrame, keys: list[str] | None = None, tie: str = "raw_content_hash") -> DataFrame:
    """Payloads to store: the first one per (source, url, run), none where one is stored already."""
    keys = keys or ["source_name", "url_hash", "crawl_run_id"]
    new = payloads.select(*keys, "fetched_at", tie).join(existing_keys.select(*keys), keys, "left_anti")
    return first_bodies(payloads, keys, ["fetched_at", tie], new)


def first_write_keys(existing: DataFrame, payloads: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The stored object key and hash each payload of a retry refers to."""
    keys = keys or ["source_name", "url_hash", "crawl_run_id"]
    columns = [*keys, "raw_object_key", "raw_content_hash", "fetched_at"]
    stored = existing.select(*columns).unionByName(immutable_first_write(existing, payloads, keys).select(*columns))
    kept = stored.select(*keys, "raw_object_key", "raw_content_hash")
    return payloads.drop("raw_object_key", "raw_content_hash").join(kept, keys)


def get_by_id(rawdata: DataFrame, record_id: int) -> DataFrame:
    return rawdata.filter(F.col("id") == record_id)


def by_object_key(rawdata: DataFrame) -> DataFrame:
    """The row with the highest id per object key; rows without a key are left out."""
    return pick_first(rawdata.filter(blank_to_null("raw_object_key").isNotNull()), ["raw_object_key"], [F.col("id").desc()])
