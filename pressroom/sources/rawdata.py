"""The ``rawdata`` table: reading, defaults on insert, migration, upsert into storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom.functions.ids import uuid5_url
from pressroom.functions.text import blank_to_null
from pressroom.operators.dedupe import assign_ids, upsert_rawdata
from pressroom.schemas import RAWDATA, RAWDATA_COLUMNS
from pressroom.session import materialize

RECONCILE_COLUMNS = ["id", "source_id", "url", "raw_object_key", "raw_content_hash", "status", "crawl_run_id"]


def read_rawdata(spark: SparkSession, path: str) -> DataFrame:
    """The stored table in its declared column order, whatever columns it is partitioned by."""
    return spark.read.schema(RAWDATA).parquet(path).select(*RAWDATA_COLUMNS)


def reconcile_columns(rawdata: DataFrame) -> DataFrame:
    """The columns reconciliation needs; the run id as text, a blank one as null."""
    return rawdata.select(*[blank_to_null(F.col(c).cast("string")).alias(c) if c == "crawl_run_id" else F.col(c) for c in RECONCILE_COLUMNS])


def rawdata_record(records: DataFrame, now: Column | None = None) -> DataFrame:
    """Complete crawl records to table rows. Aliases of the older contract are read, defaults filled in.

    An absent column counts as an absent key. Empty text falls through for object key, status, error message
    and times; source id and payload type only have a default when the key is absent. A record without a run
    id gets its own, derived from the record, so a replay gives the same one.
    """
    now = F.current_timestamp() if now is None else now
    have = set(records.columns)

    def raw(name: str, kind: str = "string") -> Column:
        return F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)

    def text(name: str) -> Column:
        return blank_to_null(raw(name))

    def instant(name: str) -> Column:
        return raw(name, "timestamp") if name not in have or dict(records.dtypes)[name].startswith("timestamp") else text(name).try_cast("timestamp")

    own_run = uuid5_url(F.concat_ws("|", F.lit("rawdata"), raw("source_id"), raw("url"), raw("fetched_at")))
    return records.select(
        raw("id", "bigint").alias("id"),
        (raw("source_id", "bigint") if "source_id" in have else F.lit(1).cast("bigint")).alias("source_id"),
        raw("url").alias("url"),
        raw("final_url").alias("final_url"),
        raw("http_status", "int").alias("http_status"),
        F.coalesce(text("raw_object_key"), raw("raw_html_path")).alias("raw_object_key"),
        (raw("raw_payload_type") if "raw_payload_type" in have else F.lit("text/html")).alias("raw_payload_type"),
        raw("raw_content_hash").alias("raw_content_hash"),
        F.coalesce(raw("crawl_run_id"), own_run).alias("crawl_run_id"),
        F.coalesce(text("status"), text("crawl_status"), F.lit("SUCCESS")).alias("status"),
        raw("error_type").alias("error_type"),
        F.coalesce(text("error_message"), raw("error")).alias("error_message"),
        F.coalesce(instant("fetched_at"), now).alias("fetched_at"),
        F.coalesce(instant("created_at"), now).alias("created_at"),
    )


def migrate_run_ids(rawdata: DataFrame) -> DataFrame:
    """Backfill of older rows: a run id of its own where none is set, a payload type where an object is."""
    own = uuid5_url(F.concat(F.lit("rawdata/"), F.col("id").cast("string")))
    return rawdata.withColumns(
        {
            "crawl_run_id": F.coalesce("crawl_run_id", own),
            "raw_payload_type": F.when(
                F.col("raw_payload_type").isNull() & F.col("raw_object_key").isNotNull(), F.lit("text/html")
            ).otherwise(F.col("raw_payload_type")),
        }
    )


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


#: Runs of a batch that are named in the filter on the table; a batch of more runs finds them by a join.
NAMED_RUNS = 1000


def _touched(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The rows of the batch's runs. Up to ``NAMED_RUNS`` only the folders of these runs are listed and read."""
    runs = [r[0] for r in batch.select("crawl_run_id").distinct().limit(NAMED_RUNS + 1).collect()]
    if len(runs) > NAMED_RUNS:
        wanted = batch.select(F.col("crawl_run_id").alias("_run")).distinct()
        return stored.join(wanted, F.col("crawl_run_id").eqNullSafe(F.col("_run")), "left_semi")
    named = F.col("crawl_run_id").isin([r for r in runs if r is not None])
    return stored.where(named | F.col("crawl_run_id").isNull() if None in runs else named)


def highest_id(spark: SparkSession, table: str) -> int | None:
    """The highest id given out, as noted beside the table; null if nothing is noted."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}/_ids")
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    notes = [f.getPath().getName() for f in files.listStatus(p)] if files.exists(p) else []
    return max((int(n.rpartition("-")[2]) for n in notes if n.startswith("upto-")), default=None)


def _note_highest_id(spark: SparkSession, table: str, value: int) -> None:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}/_ids")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.create(jvm.org.apache.hadoop.fs.Path(folder, f"upto-{value}"), True).close()
    for old in files.listStatus(folder):
        name = old.getPath().getName()
        if name.startswith("upto-") and int(name.rpartition("-")[2]) < value:
            files.delete(old.getPath(), False)


def merge_into_storage(spark: SparkSession, incoming: DataFrame, table: str, staging: str) -> None:
    """Upsert a batch into the stored table, reading and rewriting only the runs the batch touches.

    The merged runs are written to ``staging`` first and copied from there, so a job that dies half-way is
    simply run again: a finished staging folder is reused instead of merging twice. Rebalancing splits a run that
    holds most of the rows over several writers. The highest id is noted beside the table before rows with new ids go in, so no merge
    looks for it among the rows; a table without the note is searched once.
    """
    if not _exists(spark, f"{staging}/numbered/_SUCCESS"):
        batch = incoming.select(*RAWDATA_COLUMNS)
        start = highest_id(spark, table)
        if _exists(spark, table):
            stored = read_rawdata(spark, table)
            merged = upsert_rawdata(_touched(stored, batch), batch)
            if start is None:
                start = stored.agg(F.max("id")).first()[0]
        else:
            merged = upsert_rawdata(batch.filter(F.lit(False)), batch)
        assign_ids(materialize(merged, f"{staging}/merged"), start or 0).write.mode("overwrite").parquet(f"{staging}/numbered")
    numbered = spark.read.schema(RAWDATA).parquet(f"{staging}/numbered")
    highest = max(numbered.agg(F.max("id")).first()[0] or 0, highest_id(spark, table) or 0)
    _note_highest_id(spark, table, highest)
    numbered.hint("rebalance", "crawl_run_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "crawl_run_id").parquet(table)
