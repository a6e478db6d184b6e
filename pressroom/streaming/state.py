"""What a stream has seen, kept as state of its own and not looked up in the table it writes.

Each key (source and URL hash) has one entry in the state store. A batch costs what it holds: its rows are shuffled by key, and every key
is one read and at most one write of the store, however much was seen before. The store is RocksDB on the executors, with changes going to
the checkpoint folder, so neither memory nor a batch grows with history, and a lost executor gets its part back from there.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pressroom.functions import urls as U

KEY = ["source_name", "url_hash"]
_STORE = "spark.sql.streaming.stateStore."
SETTINGS = {
    f"{_STORE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}rocksdb.changelogCheckpointing.enabled": "true",
}


def use_state_store(spark: SparkSession) -> None:
    """State on disk, and only its changes in the checkpoint; settings the session already has are left as they are."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) in (None, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider", "false"):
            spark.conf.set(name, value)


class FirstSighting(StatefulProcessor):
    """Hands on the first row of a key that was not seen before, by the order of the given columns (nulls first)."""

    def __init__(self, order: list[str], ttl: timedelta | None) -> None:
        self.order = order
        self.ttl = None if ttl is None else int(ttl.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("seen", T.BooleanType())]), self.ttl)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.seen.update((True,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.seen.exists():
            return
        self.seen.update((True,))
        yield min(rows, key=lambda r: [(r[c] is not None, r[c]) for c in self.order])

    def close(self) -> None:
        pass


def first_sightings(candidates: DataFrame, order: list[str] | None = None, ttl: timedelta | None = None, known: DataFrame | None = None) -> DataFrame:
    """Rows of a stream (with ``source_name`` and ``url``) whose URL its source had not yet, with ``url_hash``; of a batch's rows the first.

    Without ``ttl`` a URL passes once, ever. With it, an entry goes when it is that old by the clock, and the URL can pass again: the size of the
    state is then bounded by what arrives in that time. Such a query looks for old entries for ever, so it needs a trigger by time: ``availableNow`` would
    not end. ``known`` (source_name, url_hash) counts as seen when the stream starts for the first time.
    A null source or URL is a value like any other.
    """
    use_state_store(candidates.sparkSession)
    hashed = candidates.withColumn("url_hash", U.short_hash("url"))
    order = order or [c for c in ("position",) if c in candidates.columns] or ["url"]
    seen = None
    if known is not None:
        seen = known.select(*[F.col(c).cast(hashed.schema[c].dataType) for c in KEY]).groupBy(*KEY)
    return hashed.groupBy(*KEY).transformWithState(
        FirstSighting(order, ttl), hashed.schema, "append", "processingTime" if ttl else "none", initialState=seen
    )
