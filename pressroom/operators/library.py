"""What comes after ingestion: canonical articles, language, chunks, fusion of given rankings.

Lexical, vector and hybrid search are in ``lexical``, ``vectors`` and ``hybrid``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pressroom.functions.text import clean_text
from pressroom.functions.urls import let
from pressroom.operators.components import connected_components

# Frequent function words by language.
FUNCTION_WORDS = {
    "de": ["der", "die", "und", "das", "nicht", "mit", "ist", "den", "von", "ein"],
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was"],
    "es": ["el", "que", "y", "los", "del", "las", "por", "con", "una", "no"],
    "fr": ["le", "et", "les", "des", "du", "est", "dans", "qui", "une", "pas"],
}


def canonical_articles(articles: DataFrame, keys: list[str], article_id: str = "article_id", links: DataFrame | None = None) -> DataFrame:
    """article_id and canonical_id: articles that share any of the key columns, or are linked, are one story.

    The canonical article is the one with the smallest id of all that can be reached; every article keeps its row, as
    provenance. Null keys match nothing. ``links`` (a, b) adds pairs found by other means, such as near duplicates.
    """
    ids = articles.select(F.col(article_id).alias("id"), *keys)
    edges = links.select("a", "b") if links is not None else None
    for key in keys:  # a star per value, so a value shared by a third of all articles is only aggregated
        first = ids.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z")
        star = ids.join(first, F.col(key) == F.col("_k")).where("id != a").select("a", F.col("id").alias("b"))
        edges = star if edges is None else edges.unionByName(star)
    found = connected_components(edges)
    return ids.select("id").distinct().join(found, "id", "left").select(F.col("id").alias(article_id), F.coalesce("component", "id").alias("canonical_id"))


def words_of(text: Column | str) -> Column:
    """Lower-case words between blanks."""
    return F.filter(F.split(F.lower(clean_text(text)), " "), lambda w: w != "")


def language_id(text: Column | str, function_words: dict[str, list[str]] = FUNCTION_WORDS) -> Column:
    """The language whose function words are most frequent in the text; the first by name on ties, null without any."""

    def best(words: Column) -> Column:
        # of equal counts the smallest name: later names come first, so an earlier one has the larger turn
        names = sorted(function_words, reverse=True)
        ranked = F.array(*[
            F.struct(_count(words, function_words[n]).alias("n"), F.lit(turn).alias("turn"), F.lit(n).alias("language")) for turn, n in enumerate(names)
        ])
        return let(F.array_max(ranked), lambda top: F.when(top["n"] > 0, top["language"]))

    return let(words_of(text), best)


def _count(words: Column, listed: list[str]) -> Column:
    return F.coalesce(F.size(F.filter(words, lambda w: w.isin(listed))), F.lit(0))


def chunk_articles(articles: DataFrame, size: int = 200, overlap: int = 40, article_id: str = "article_id", text: str = "content") -> DataFrame:
    """article_id, chunk_no (from 0), n_words and chunk: windows of ``size`` words, each repeating the last ``overlap`` of the one before."""
    if not 0 <= overlap < size:
        raise ValueError("the overlap must be smaller than a chunk")
    split = articles.select(F.col(article_id), F.split(clean_text(text), " ").alias("_w")).where(F.size("_w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("_w") - overlap - 1, F.lit(0)), F.lit(size - overlap))
    each = split.select(article_id, F.posexplode(F.transform(starts, lambda s: F.slice(F.col("_w"), s + 1, F.lit(size)))).alias("chunk_no", "_c"))
    return each.select(article_id, "chunk_no", F.size("_c").alias("n_words"), F.array_join("_c", " ").alias("chunk"))


def hybrid_rank(lexical: DataFrame, vector: DataFrame, k: int = 10, damping: int = 60, article_id: str = "article_id") -> DataFrame:
    """Reciprocal-rank fusion of two rankings (query_id, rank, article_id): an article's score is the sum of 1 / (damping + rank)."""
    a = lexical.select("query_id", article_id, F.col("rank").alias("lexical_rank"))
    b = vector.select("query_id", article_id, F.col("rank").alias("vector_rank"))
    part = [F.coalesce(1 / (F.lit(damping) + F.col(c)), F.lit(0.0)) for c in ("lexical_rank", "vector_rank")]
    scored = a.join(b, ["query_id", article_id], "full").withColumn("score", F.round(part[0] + part[1], 9))
    best = W.partitionBy("query_id").orderBy(F.desc("score"), article_id)
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", article_id, "lexical_rank", "vector_rank", "score")
