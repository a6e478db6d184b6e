"""Exact histogram of encoded lengths, and what it answers for every context limit.

Documents are only counted per encoded length, with map-side combining; everything else follows from suffix sums over the
distinct lengths. A null text has length 0. Rows, repeated or not, count once each. No documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm.tokens import encoder
from pressroom.llm.words import pieces
from pressroom.operators.running import running

#: Lengths whose sums are taken in one window; the next level has one row for each.
SPAN = 4096


def encoded_lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row (n_tokens) per document, without end ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays([pa.array(np.diff(encoder(tokenizer).encode(piece.column("text"))[1]))], ["n_tokens"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "n_tokens bigint")


def length_histogram(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per length that occurs, as a context limit.

    n_docs and tokens of exactly that length; docs_at_least, tokens_at_least: of that length or more; docs_at_most; truncated_total: ids
    that stay when every document is cut to the limit; total_docs, total_tokens.
    """
    lengths = encoded_lengths(docs, tokenizer).groupBy(F.col("n_tokens").alias("context_limit")).agg(F.count("*").alias("n_docs"))
    span = lengths.withColumns({"down": -F.col("context_limit"), "span": -F.floor(F.col("context_limit") / SPAN)})
    tokens = F.col("context_limit") * F.col("n_docs")
    sums = running(span, [], ["span"], ["down"], {"docs_at_least": ("sum", F.col("n_docs")), "tokens_at_least": ("sum", tokens)})
    totals = lengths.agg(F.sum("n_docs").alias("total_docs"), F.sum(tokens).alias("total_tokens"))
    below = F.col("total_tokens") - F.col("tokens_at_least")
    return sums.crossJoin(F.broadcast(totals)).select(  # one row of totals
        "context_limit", "n_docs", tokens.alias("tokens"), "docs_at_least", "tokens_at_least",
        (F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_at_most"),
        (below + F.col("context_limit") * F.col("docs_at_least")).alias("truncated_total"), "total_docs", "total_tokens",
    )


def length_quantile(histogram: DataFrame, share: float) -> DataFrame:
    """The smallest length that at least ``share`` of all documents do not exceed, as one row (n_tokens)."""
    return histogram.where(F.col("docs_at_most") >= F.ceil(share * F.col("total_docs"))).agg(F.min("context_limit").alias("n_tokens"))


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """Ids that stay when every document is cut to ``limit``, for a limit between or beyond the lengths too."""
    longer = F.col("context_limit") > limit
    kept = F.when(longer, limit).otherwise(F.col("context_limit")) * F.col("n_docs")
    return histogram.agg(F.coalesce(F.sum(kept), F.lit(0)).alias("truncated_total"))
