"""Reciprocal-rank fusion of a lexical and a vector ranking over whole rankings, read no deeper than the result needs.

An article's score is the sum of 1 / (damping + rank) over the rankings it is in. Of the k best of one ranking alone each scores at least
1 / (damping + k); what stands below ``depth = damping + 2 k`` in both scores at most 2 / (damping + depth + 1), which is less. So the ``depth`` first of
both rankings hold the k best of the fusion. An article that is found in one of them only may still have a rank in the other: such ranks are looked
up by counting, for the articles that could get among the best with the rank they would have at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pressroom.operators import lexical as lex
from pressroom.operators import vectors as vec
from pressroom.session import materialize


def _share(rank: str, damping: int):
    return F.coalesce(1 / (F.lit(damping) + F.col(rank)), F.lit(0.0))


def hybrid_search(lexical: lex.LexicalIndex, vectors: vec.VectorIndex, queries: DataFrame, k: int = 10, damping: int = 60, vector: str = "embedding") -> DataFrame:
    """query_id, rank, article id, lexical_rank, vector_rank and score of the ``k`` best of the fused rankings.

    ``queries`` has query_id and embedding; the words of the queries are those of the lexical index. A query may be in one of both only. Ranks are null
    where an article shares no word with the query, or has no vector. Scores are rounded to 9 places, ties go to the smaller id.
    """
    key = lexical.article_id
    depth = damping + 2 * k
    a = lex.search_lexical(lexical, depth).select("query_id", F.col(key).alias("id"), F.col("rank").alias("lexical_rank"))
    b = vec.search_index(vectors, queries, depth, vector=vector).select("query_id", F.col(vectors.article_id).alias("id"), F.col("rank").alias("vector_rank"))
    known = materialize(a.join(b, ["query_id", "id"], "full").withColumn("part", _share("lexical_rank", damping) + _share("vector_rank", damping)))

    # of each query the k-th best of what is known, and the most that a missing rank can add
    place = W.partitionBy("query_id").orderBy(F.desc("part"), "id")
    floors = known.withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= k).groupBy("query_id").agg(F.min("part").alias("floor"), F.max("_n").alias("_n"))
    floors = floors.select("query_id", F.when(F.col("_n") == k, F.col("floor")).otherwise(0.0).alias("floor"))
    single = known.where("lexical_rank is null or vector_rank is null").join(floors, "query_id")
    open_ = materialize(single.where(F.col("part") + 1.0 / (damping + depth + 1) >= F.col("floor") - 1e-8).select("query_id", "id", "lexical_rank", "vector_rank"))

    asked = queries.select("query_id", vector).dropDuplicates(["query_id"])
    nearer = vec.better_counts(vectors, open_.where("vector_rank is null").select("query_id", "id").join(asked, "query_id"), vector)
    more_words = lex.better_counts(lexical, open_.where("lexical_rank is null").select("query_id", "id"))
    looked_up = nearer.select("query_id", "id", F.lit(None).cast("int").alias("_l"), (F.col("better") + 1).cast("int").alias("_v")).unionByName(
        more_words.select("query_id", "id", (F.col("better") + 1).cast("int").alias("_l"), F.lit(None).cast("int").alias("_v"))
    )
    ranks = known.drop("part").join(materialize(looked_up), ["query_id", "id"], "left")
    ranks = ranks.select("query_id", "id", F.coalesce("lexical_rank", "_l").alias("lexical_rank"), F.coalesce("vector_rank", "_v").alias("vector_rank"))
    scored = ranks.withColumn("score", F.round(_share("lexical_rank", damping) + _share("vector_rank", damping), 9))
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(key), "lexical_rank", "vector_rank", "score"
    )
