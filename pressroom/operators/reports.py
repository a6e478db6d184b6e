"""Counts, listings and run statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.functions.text import blank_to_null, content_length, text_or

SKIPPED = "SKIPPED_EXISTING"


def count_rawdata(rawdata: DataFrame, status: str | None = None) -> DataFrame:
    rows = rawdata.filter(F.col("status") == status) if status else rawdata
    return rows.agg(F.count(F.lit(1)).alias("n_rows"))


def count_by_status(rawdata: DataFrame) -> DataFrame:
    return rawdata.groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"))


def latest_rawdata(rawdata: DataFrame, limit: int = 10) -> DataFrame:
    """Newest rows by id; a top-k in every task, merged at the end."""
    return rawdata.orderBy(F.col("id").desc()).limit(limit)


def run_stats(outcomes: DataFrame, by: str = "source_name", status: str = "status") -> DataFrame:
    """Discovered, skipped, success and failed per group, and in total (the row whose group is null).

    ``is_total`` tells the total row from a group without a name.
    """
    s = F.col(status)
    return outcomes.rollup(by).agg(
        (F.grouping(by) == 1).alias("is_total"),
        F.count(F.lit(1)).alias("discovered"),
        F.count_if(s == SKIPPED).alias("skipped"),
        F.count_if(s == "SUCCESS").alias("success"),
        F.count_if(~F.coalesce(s.isin(SKIPPED, "SUCCESS"), F.lit(False))).alias("failed"),
    )


def failure_lines(outcomes: DataFrame, run: str = "crawl_run_id") -> DataFrame:
    """``url: status`` of everything in a run that did not succeed, one row each."""
    bad = ~F.coalesce(F.col("status").isin("SUCCESS", SKIPPED), F.lit(False))
    return outcomes.filter(bad).select(
        run, "url", "status", F.concat(F.col("url"), F.lit(": "), text_or("status", "UNKNOWN")).alias("line"))


def batch_outcome(outcomes: DataFrame, run: str = "crawl_run_id") -> DataFrame:
    """Whether each run failed: one bad URL does not stop the others, but fails the batch."""
    bad = ~F.coalesce(F.col("status").isin("SUCCESS", SKIPPED), F.lit(False))
    return outcomes.groupBy(run).agg(F.count(F.lit(1)).alias("urls"), F.count_if(bad).alias("failures")).withColumn(
        "batch_failed", F.col("failures") > 0)


def record_summary(records: DataFrame, fields: list[str] | None = None, key: str = "url") -> DataFrame:
    """Status, title, content length and the names of the fields that are set, in schema order."""
    fields = fields or records.columns
    filled = F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.lit(f)) for f in fields]))
    return records.select(
        key, "status", "title", content_length("content").alias("content_chars"), "raw_object_key", filled.alias("metadata_fields"))


def rate(part: Column, whole: Column) -> Column:
    """Share as a double, null when there is nothing to share."""
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")


def is_set(c: str) -> Column:
    return blank_to_null(c).isNotNull()
