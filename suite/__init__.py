"""Registered queries: each operator over the driver tables, with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under the id of its operator; ``sql`` is what DuckDB runs on the same tables."""

    def add(fn: Query) -> Query:
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def load_all() -> None:
    from suite import articles, discovery, functions, ingestion, library, lookups, reporting, storage, streams  # noqa: F401
