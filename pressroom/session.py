"""Session settings and size-checked broadcasting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_LIMIT = 64 * 1024 * 1024
#: The optimizer's estimate of a stored table is its compressed size; in memory it can be as many times larger.
EXPANSION = 4


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings the session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pressroom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage: the cluster's setting, a local one only where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="pressroom-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write an intermediate table and read it back, where several later steps would each compute it anew.

    The table lies in the shared checkpoint folder, so a lost executor costs nothing but a re-read. Its size is
    known afterwards, which lets Spark pick the joins it feeds.
    """
    spark = df.sparkSession
    folder = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


#: Bytes of rows that go to a task's Python at once, as an Arrow batch lies in the memory of both sides; Spark's default is 64 MB.
BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Hand whole pages to Python in batches of ``BATCH_BYTES``, unless the session has a setting of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, "67108864b") in ("67108864b", "64MB"):  # as it is by default
        spark.conf.set(name, str(BATCH_BYTES))


def plan_bytes(df: DataFrame) -> int:
    """Upper estimate of a DataFrame's size by the optimizer."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Ask for a broadcast only when the estimate stays under the limit.

    Past the limit the join is left to Spark: a shuffle join, split by AQE where keys are skewed.
    """
    return F.broadcast(df) if plan_bytes(df) * EXPANSION <= limit else df
