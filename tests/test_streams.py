"""Deduplication by state: exactness, restarts, replays, expiry, and what a batch reads."""

import random
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from pressroom.functions import urls as U
from pressroom.streaming import jobs
from pressroom.streaming.state import first_sightings

SCHEMA = "source_name string, url string, position array<bigint>"


def land(spark, folder, number, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/landing/{number}")


def run(spark, folder, **options):
    landing = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(f"{folder}/landing")
    query = jobs.stream_dedupe(landing, f"{folder}/urls", f"{folder}/checkpoint", **options).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stored(spark, folder):
    rows = spark.read.schema(SCHEMA + ", url_hash string").parquet(f"{folder}/urls").collect()
    return sorted((r.source_name or "", r.url or "", r.position or []) for r in rows)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "landing").mkdir()
    return str(tmp_path)


def test_restart_and_replay(spark, folder):
    rng = random.Random(4)
    batches = [[(rng.choice("ab"), f"u{rng.randrange(12)}", [b, i]) for i in range(15)] for b in range(4)]
    want = {}
    for rows in batches:
        first = {}
        for source, url, position in rows:
            first.setdefault((source, url), position)
        want = first | want
    for number, rows in enumerate(batches[:2]):
        land(spark, folder, number, rows)
        run(spark, folder)  # each a restart
    land(spark, folder, 2, batches[2])
    run(spark, folder)
    done = sorted((s, u, p) for (s, u), p in want.items() if p[0] < 3)
    assert stored(spark, folder) == done
    # the driver died before it noted the end of its last batch: that batch runs again
    import pathlib

    last = max(pathlib.Path(f"{folder}/checkpoint/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    run(spark, folder)
    assert stored(spark, folder) == done
    land(spark, folder, 3, batches[3])
    run(spark, folder)
    assert stored(spark, folder) == sorted((s, u, p) for (s, u), p in want.items())


def test_known_urls_and_nulls(spark, folder):
    known = spark.createDataFrame([("a", "u1"), ("b", "u2")], "source_name string, url string").select("source_name", U.short_hash("url").alias("url_hash"))
    land(spark, folder, 0, [("a", "u1", None), ("a", "u2", None), ("b", "u2", [1]), (None, "u1", [2]), (None, "u1", [1]), ("a", None, [0]), ("a", None, None)])
    run(spark, folder, known=known)
    assert stored(spark, folder) == [("", "u1", [1]), ("a", "", []), ("a", "u2", [])]
    land(spark, folder, 1, [("b", "u2", [5]), (None, "u1", [0]), ("a", None, None), ("b", "u1", [3])])
    run(spark, folder, known=known)
    assert stored(spark, folder) == [("", "u1", [1]), ("a", "", []), ("a", "u2", []), ("b", "u1", [3])]


def test_expiry(spark, folder):
    """With an age limit a query never runs out of work to look for, so it is stopped from outside."""

    def run_until(rows):
        landing = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{folder}/landing")
        query = jobs.stream_dedupe(landing, f"{folder}/urls", f"{folder}/checkpoint", ttl=timedelta(seconds=2)).trigger(processingTime="100 milliseconds").start()
        end = time.time() + 30
        while time.time() < end and sum(p["numInputRows"] for p in query.recentProgress) < rows:
            time.sleep(0.2)
        query.stop()

    land(spark, folder, 0, [("a", "u1", [0])])
    run_until(1)
    time.sleep(2.5)
    land(spark, folder, 1, [("a", "u1", [1])])
    run_until(1)
    assert stored(spark, folder) == [("a", "u1", [0]), ("a", "u1", [1])]


def test_a_batch_reads_itself_and_its_state(spark, folder):
    for number in range(3):
        land(spark, folder, number, [("a", f"u{i}", [number, i]) for i in range(number * 10, number * 10 + 20)])
        query = run(spark, folder)
    plan = query._jsq.explainInternal(True)
    scans = [line for line in plan.splitlines() if "FileScan" in line or "BatchScan" in line]
    assert "TransformWithState" in plan and "HashJoin" not in plan and "MergeJoin" not in plan and not any("/urls" in line for line in scans)
    progress = query.lastProgress
    assert progress["numInputRows"] == 20 and progress["stateOperators"][0]["numRowsTotal"] == 40


def test_discovery_in_two_streams(spark, folder):
    land(spark, folder, 0, [("a", "u1", [0]), ("a", "u2", [1])])
    land(spark, folder, 1, [("a", "u2", [0]), ("b", "u2", [1])])
    land(spark, folder, 2, [])
    landing = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(f"{folder}/landing")
    find = lambda batch: batch.withColumn("url", F.concat(F.lit("https://e.com/"), "url"))
    jobs.stream_discover(landing, find, f"{folder}/links", f"{folder}/c1").trigger(availableNow=True).start().awaitTermination()
    jobs.stream_discover(landing, find, f"{folder}/links", f"{folder}/c1").trigger(availableNow=True).start().awaitTermination()
    links = jobs.link_stream(spark, landing, find, f"{folder}/links")
    jobs.stream_dedupe(links, f"{folder}/urls", f"{folder}/c2").trigger(availableNow=True).start().awaitTermination()
    assert [(s, u) for s, u, _ in stored(spark, folder)] == [("a", "https://e.com/u1"), ("a", "https://e.com/u2"), ("b", "https://e.com/u2")]


def test_a_stream_that_never_had_a_row(spark, folder):
    empty = spark.readStream.schema(SCHEMA).parquet(f"{folder}/landing")
    jobs.stream_dedupe(empty, f"{folder}/urls", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert first_sightings(empty).isStreaming


def test_landing_has_more_files_the_larger_it_is():
    from suite.streams import _landing_files

    assert _landing_files(0) == _landing_files(60 << 20) == (4, 2)
    assert _landing_files(1 << 30) == (64, 32) and _landing_files(10 << 30) == (640, 48)
