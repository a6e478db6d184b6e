"""Time the headline queries and print one JSON line.

Each query is written to Spark's ``noop`` sink, so every row and column is computed and nothing is
collected. The first run of a query warms the JVM and is not counted; the best of the next two is.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import suite  # noqa: E402
from pressroom.session import local_session  # noqa: E402

HEADLINE = [
    "e1_new_page_quality", "e1_crawl_articles", "x7_content_paragraphs", "x8_main_text_fallback", "x8_main_text_block", "u1_normalize_url_v1", "u2_normalize_url_v2",
    "t3_strip_html", "d1_discover_rss", "d2_discover_api", "d2d_api_circuit_breaker", "d3_discover_listing", "j1_resolve_source",
    "j2_dedupe_first_wins", "j3_skip_any_artifact", "j7_upsert_rawdata", "a3_run_stats", "a12_reconcile_report", "v4_validate_metadata",
    "b1_crawl_items_upsert", "b7_politeness_schedule", "b8_reliability_metrics",
]


def split_tables(spark, sf_dir: str, parts: int) -> str:
    """The tables in as many files as there are cores, as a large store would bring them; small ones are one split otherwise."""
    folder = tempfile.mkdtemp(prefix="bench-")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        spark.read.parquet(str(path)).repartition(parts).write.parquet(f"{folder}/{path.name}")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    suite.load_all()
    spark = local_session(cpus, int(cpus))
    sf_dir = split_tables(spark, sf_dir, int(cpus))
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            suite.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs[1:]), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": Path(os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
