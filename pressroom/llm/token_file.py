"""Token ids in files of Simple-8b words.

A file is a Parquet table of blocks, in order. A block holds whole documents, about 65,536 ids. Ids are coded as id + 1 in words of
64 bits: the top 4 bits select how many codes of how many bits fill the other 60. Code 0 is an escape: an id that needs more
than 15 bits stands in a list beside the words, so that one large id doesn't widen its neighbours. A document begins at a new
word, and each block lists where its documents begin, in ids and in words, so that a block decodes selector by selector
without a loop over words, and a single document can be decoded alone.

Documents go out in ascending doc_id (null first; repeated ids by a hash of their text, so repeats are kept). A null text is an empty
one: the end id alone. An empty table gives an empty file. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pressroom.llm.tokens import encoder
from pressroom.llm.words import U64, pieces, trim

BLOCK_IDS = 1 << 16
ESCAPE_BITS = 15
#: Fixed values of the coding: codes per word and bits per code, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
_BITS = np.ceil(np.log2(np.arange(1 << ESCAPE_BITS) + 1.0)).astype(np.int8)
SCHEMA = (
    "shard int, block int, first_id bigint, doc_id array<bigint>, ids_at array<int>, words_at array<int>, words binary, escapes binary"
)


def pack(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of the documents ids[at[i]:at[i + 1]], the first word of each (and the number of all), and the escaped ids."""
    codes = ids.astype(U64) + U64(1)
    escaped = codes >= U64(1 << ESCAPE_BITS)
    codes[escaped] = 0
    n = len(codes)
    bits = _BITS[codes]
    here = np.arange(n, dtype=np.int32)
    limit = np.repeat(at[1:], np.diff(at)).astype(np.int32) - here
    chosen = np.full(n, 15, np.uint8)
    reach, of_width = limit, 99
    for selector in range(14, -1, -1):  # the last that fits holds the most codes
        count, width = COUNTS[selector], WIDTHS[selector]
        if width < ESCAPE_BITS and width != of_width:
            narrow = bits <= width
            if np.count_nonzero(narrow) < count:
                break  # neither do narrower ones
            stop = np.where(narrow, n, here)
            reach, of_width = np.minimum(np.minimum.accumulate(stop[::-1])[::-1] - here, limit), width
        chosen[reach >= count] = selector
    steps = COUNTS[chosen].astype(np.uint8).tobytes()
    heads = []
    i = 0
    while i < n:
        heads.append(i)
        i += steps[i]
    heads = np.array(heads, np.int64)
    selectors = chosen[heads]
    words = selectors.astype(U64) << U64(60)
    for selector in np.unique(selectors):
        width = int(WIDTHS[selector])
        if width:
            mine = selectors == selector
            first, filled = heads[mine], words[mine]
            for lane in range(COUNTS[selector]):
                filled |= codes[first + lane] << U64(lane * width)
            words[mine] = filled
    return words, np.searchsorted(heads, at), ids[escaped].astype(np.uint32)


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """All ids of a run of words; ``escapes`` are those of the same run."""
    selectors = (words >> U64(60)).astype(np.int64)
    ends = np.cumsum(COUNTS[selectors])
    codes = np.zeros(ends[-1] if len(ends) else 0, U64)
    for selector in np.unique(selectors):
        width = int(WIDTHS[selector])
        if width:
            mine = selectors == selector
            first, filled, mask = ends[mine] - COUNTS[selector], words[mine], U64((1 << width) - 1)
            for lane in range(COUNTS[selector]):
                codes[first + lane] = (filled >> U64(lane * width)) & mask
    ids = (codes - U64(1)).astype(np.uint32)
    ids[codes == 0] = escapes
    return ids


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 1, at_once: int = 4 << 20) -> None:
    """Encode ``text`` of every row and write the ids to ``path`` in order of doc_id; ``tokenizer`` is a file's path.

    About ``at_once`` bytes of whole texts are encoded at a time: more of them take less time and more memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard, made, written = context.partitionId() if context else 0, 0, 0
        waiting: list[tuple[list, np.ndarray, np.ndarray]] = []
        size = 0

        def block() -> pa.RecordBatch:
            nonlocal made, written, size
            doc_ids = [d for part in waiting for d in part[0]]
            ids = np.concatenate([part[1] for part in waiting])
            at = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(part[2]) for part in waiting]))])
            words, words_at, escapes = pack(ids, at)
            row = [shard, made, written, doc_ids, at.tolist(), words_at.tolist(), words.astype("<u8").tobytes(), escapes.astype("<u4").tobytes()]
            made, written, size = made + 1, written + len(ids), 0
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)

        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            for piece in pieces(batch, "text", at_once):
                ids, at = encoder(tokenizer).encode(piece.column("text"))
                if end_id is not None:
                    ids = np.insert(ids, at[1:], end_id)
                    at = at + np.arange(len(at))
                doc_ids = piece.column("doc_id").to_pylist()
                a = 0
                while a < len(doc_ids):  # whole documents until the block is full
                    b = int(np.searchsorted(at, at[a] + BLOCK_IDS - size, "left"))
                    b = min(max(b, a + 1), len(doc_ids))
                    waiting.append((doc_ids[a:b], ids[at[a] : at[b]], at[a : b + 1] - at[a]))
                    size += int(at[b] - at[a])
                    a = b
                    if size >= BLOCK_IDS:
                        yield block()
        if waiting:
            yield block()
        trim()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    rows.mapInArrow(run, SCHEMA).write.mode("overwrite").option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files.

    ``start`` counts the ids of all documents before; the checksum is the unsigned crc32 of the ids as little-endian unsigned 32-bit numbers.
    """
    blocks = spark.read.schema(SCHEMA).parquet(path)
    ends = blocks.groupBy("shard").agg(F.sum(F.element_at("ids_at", -1).cast("bigint")).alias("n"))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one row a file
    bases = ends.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("bigint").alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["escapes"], "<u4")).astype("<u4")
                at = row["ids_at"]
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * n, pa.int32()), pa.array(row["doc_id"], pa.int64()),
                        pa.array(np.array(at[:-1], np.int64) + row["first_id"]), pa.array(np.diff(np.array(at, np.int64))), pa.array(crc, pa.int64()),
                    ],
                    ["shard", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    found = blocks.mapInArrow(run, "shard int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(bases, "shard").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
