"""From raw documents to token ids: toxic documents go, one of each group of near duplicates stays, documents that contain
test items go, sources are mixed to equal weights, and what is left is written as token ids.

Each stage takes all that its predecessor kept, read again from Parquet, and all but the last return the columns of ``documents``, extra
ones included. Nulls, empty tables and repeated rows are as each operator's module says; rows with a null doc_id pass every filter.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressroom.llm.decontaminate import without_contaminated
from pressroom.llm.mixing import replicate, shuffled, source_rates
from pressroom.llm.neardup import without_near_duplicates
from pressroom.llm.token_file import read_ids, write_ids
from pressroom.llm.tokens import DEFAULT_TOKENIZER, tokenizer_path
from pressroom.llm.toxicity import scored, train
from pressroom.llm.words import small_batches
from pressroom.session import ensure_checkpoint_dir, materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine, fitted on labelled ones, gives a probability under one half."""
    small_batches(spark)
    model = train(docs, _table(spark, sf_dir, "labels"), F.lit(True))
    return scored(docs, model, docs.columns, "_toxicity").where(F.col("_toxicity") < 0.5).drop("_toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more on five-word shingles."""
    small_batches(spark)
    return without_near_duplicates(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no test item aligns with."""
    small_batches(spark)
    return without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their source's rate, so that sources weigh alike, and shuffled."""
    small_batches(spark)
    copies = replicate(docs, source_rates(docs), seed="pipeline", copy="_copy")
    return shuffled(copies, seed="pipeline", copy="_copy").select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, as read back from the token file."""
    small_batches(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-ids-{uuid.uuid4().hex}"
    write_ids(docs, path, tokenizer_path(DEFAULT_TOKENIZER), end_id=1, at_once=1 << 18)
    return read_ids(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_ids", write_tokens),
]

#: Learned weights, min-hash links and BPE have no SQL twin. The tests run the stages: the operators of each are compared with brute force in tests of
#: their own, mixing as a subset of its input and token ids by their order.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs)
    return docs
