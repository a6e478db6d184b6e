"""Reconciliation of stored artifacts against the ``rawdata`` table.

Inputs: ``rows`` (see ``sources.rawdata.reconcile_columns``), ``metadata`` (see
``sources.artifacts.read_metadata``) and ``raw_files`` (``raw_object_key, content_hash``). Findings are
rows, one per finding: a list per category would grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.functions.text import blank_to_null
from pressroom.functions.urls import is_safe_object_key, normalized_object_key

FINDING = {
    "category": "string", "metadata_path": "string", "schema_version": "int", "raw_object_key": "string",
    "database_id": "bigint", "source_id": "bigint", "crawl_run_id": "string", "url": "string",
    "expected": "string", "actual": "string", "error": "string",
}


def _finding(df: DataFrame, category: str) -> DataFrame:
    have = set(df.columns)
    return df.select(
        F.lit(category).alias("category"),
        *[(F.col(c).cast(t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in FINDING.items() if c != "category"],
    )


def duplicate_run_urls(rows: DataFrame) -> DataFrame:
    """Rows that share (source, run, url) with another row, one finding per row; null keys are keys too."""
    keys = ["source_id", "crawl_run_id", "url"]
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    g = groups.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = None
    for k in keys:
        test = F.col(k).eqNullSafe(F.col(f"_{k}"))
        same = test if same is None else same & test
    return _finding(rows.join(g, same, "left_semi").withColumnRenamed("id", "database_id"), "database_duplicate_run_urls")


def raw_without_row(raw_files: DataFrame, rows: DataFrame) -> DataFrame:
    keyed = rows.filter(blank_to_null("raw_object_key").isNotNull()).select("raw_object_key")
    return _finding(raw_files.select("raw_object_key").join(keyed, "raw_object_key", "left_anti"), "raw_files_without_database_row")


def _metadata_with_row(metadata: DataFrame, rows: DataFrame) -> DataFrame:
    """Sidecars with the id of the row that holds their object key, null when there is none."""
    newest = rows.filter(blank_to_null("raw_object_key").isNotNull()).groupBy(F.col("raw_object_key").alias("_row_key")).agg(
        F.max("id").alias("database_id"))
    return metadata.select("metadata_path", "readable", "schema_version", "raw_object_key", "raw_content_hash").join(
        newest, F.col("raw_object_key") == F.col("_row_key"), "left").drop("_row_key")


def references(metadata: DataFrame, rows: DataFrame) -> DataFrame:
    """Everything that points at an object: sidecars and rows with a key."""
    from_metadata = _metadata_with_row(metadata.filter("readable"), rows).filter(F.col("raw_object_key").isNotNull()).select(
        "metadata_path", "raw_object_key", "raw_content_hash", "database_id")
    from_rows = rows.filter(blank_to_null("raw_object_key").isNotNull()).select(
        F.lit(None).cast("string").alias("metadata_path"), "raw_object_key", "raw_content_hash", F.col("id").alias("database_id"))
    return from_metadata.unionByName(from_rows)


def _checked(metadata: DataFrame, rows: DataFrame, raw_files: DataFrame) -> DataFrame:
    """References next to the hash of the object they point at; an unsafe key never finds one."""
    objects = raw_files.select(F.col("raw_object_key").alias("_key"), F.col("content_hash").alias("actual"), F.lit(True).alias("_found"))
    refs = references(metadata, rows)
    wanted = F.when(is_safe_object_key("raw_object_key"), normalized_object_key("raw_object_key"))
    return refs.withColumn("_wanted", wanted).join(objects, F.col("_wanted") == F.col("_key"), "left").drop("_key", "_wanted")


def rows_without_raw(metadata: DataFrame, rows: DataFrame, raw_files: DataFrame) -> DataFrame:
    """References whose object is missing or whose key is unsafe; a sidecar and a row may both report one key."""
    return _finding(_checked(metadata, rows, raw_files).filter(F.col("_found").isNull()), "database_rows_without_raw_file")


def hash_mismatches(metadata: DataFrame, rows: DataFrame, raw_files: DataFrame) -> DataFrame:
    return _mismatches(_checked(metadata, rows, raw_files))


def _mismatches(checked: DataFrame) -> DataFrame:
    expected = blank_to_null("raw_content_hash")
    wrong = checked.filter(F.col("_found") & expected.isNotNull() & (expected != F.col("actual")))
    return _finding(wrong.withColumnRenamed("raw_content_hash", "expected"), "hash_mismatches")


def metadata_without_row(metadata: DataFrame, rows: DataFrame) -> DataFrame:
    """Unreadable sidecars, and readable ones no row refers to; version 1 goes to its own category."""
    lost = _metadata_with_row(metadata, rows).filter(F.col("database_id").isNull())
    lost = lost.withColumn("error", F.when(~F.col("readable"), F.lit("invalid JSON")))
    found = _finding(lost, "metadata_without_database_reference")
    return found.withColumn(
        "category",
        F.when(F.coalesce(F.col("schema_version") == 1, F.lit(False)), F.lit("legacy_metadata_without_database_reference"))
        .otherwise(F.col("category")),
    )


def metadata_without_raw_reference(metadata: DataFrame) -> DataFrame:
    return _finding(
        metadata.filter(F.col("readable") & F.col("raw_object_key").isNull()), "metadata_without_raw_reference")


def reconcile_report(metadata: DataFrame, rows: DataFrame | None, raw_files: DataFrame) -> DataFrame:
    """All findings in one long table; ``rows=None`` inspects files only.

    Both checks that need object hashes share one pass: an object is read and hashed once.
    """
    if rows is None:
        rows = metadata.sparkSession.createDataFrame(
            [], "id bigint, source_id bigint, url string, raw_object_key string, raw_content_hash string, status string, crawl_run_id string")
    checked = _checked(metadata, rows, raw_files)
    expected = blank_to_null("raw_content_hash")
    category = F.when(F.col("_found").isNull(), F.lit("database_rows_without_raw_file")).when(
        expected != F.col("actual"), F.lit("hash_mismatches"))
    objects = checked.withColumn("_category", category).filter(F.col("_category").isNotNull())
    mismatch = F.col("_category") == "hash_mismatches"
    object_findings = _finding(
        objects.withColumns({"expected": F.when(mismatch, F.col("raw_content_hash")), "actual": F.when(mismatch, F.col("actual"))}), ""
    )
    named = object_findings.withColumn(
        "category", F.when(F.col("actual").isNull(), F.lit("database_rows_without_raw_file")).otherwise(F.lit("hash_mismatches")))
    return (
        raw_without_row(raw_files, rows)
        .unionByName(named)
        .unionByName(metadata_without_row(metadata, rows))
        .unionByName(metadata_without_raw_reference(metadata))
        .unionByName(duplicate_run_urls(rows))
    )


def report_summary(report: DataFrame) -> DataFrame:
    return report.groupBy("category").agg(F.count(F.lit(1)).alias("findings"))
