"""Words and word shingles of whole Arrow batches as 64-bit hashes, for use inside tasks.

A word is a maximal run of bytes other than space and 0x09 to 0x0D; ASCII capitals count as small letters. A null text has
no words. Hashes are the same in every process and at every batch size.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

U64 = np.uint64
#: Bytes hashed at once: bounds the scratch memory of a task whatever the length of the texts (a single longer word aside).
WINDOW = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers over all bits (splitmix finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(_BASE) + U64(seed * 1_000_003)) | U64(1)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_FOLDED = constants(1, 256)[_LOWER]
_BYTE_EXACT = constants(1, 256)
_NTH = constants(2, 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, WINDOW + 1), U64(base))
        steps[0] = U64(1)
        have = np.multiply.accumulate(steps)
        if n <= WINDOW + 1:
            _POWERS[base] = have
    return have[:n]


@dataclass
class Words:
    """Words of a batch, texts one after another."""

    data: np.ndarray  # all bytes of the batch
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after each word
    hash: np.ndarray
    bounds: np.ndarray  # words of text i: bounds[i] up to bounds[i + 1]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text starts and ends in them; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, values = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool) -> np.ndarray:
    """Hash of data[start:end] for ascending spans that don't overlap."""
    hashes = np.empty(len(start), U64)
    table = _BYTE_FOLDED if fold else _BYTE_EXACT
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(end, start[a] + WINDOW, "right")))
        low, high = int(start[a]), int(end[b - 1])
        sums = np.zeros(high - low + 1, U64)
        np.cumsum(table[data[low:high]] * _powers(_BASE, high - low), out=sums[1:])
        s, e = start[a:b] - low, end[a:b] - low
        hashes[a:b] = mix((sums[e] - sums[s]) * _powers(_BASE_INVERSE, high - low)[s] + (e - s).astype(U64))
        a = b
    return hashes


def split_words(column: pa.Array | pa.ChunkedArray, fold: bool = True) -> Words:
    """Words of every text; ``fold`` hashes ASCII capitals as small letters."""
    data, at = text_bytes(column)
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = at[:-1] < at[1:]  # words end with their text
    heads, tails = at[:-1][filled], at[1:][filled] - 1
    first[heads] = inside[heads]
    last[tails] = inside[tails]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(data, start, end, span_hashes(data, start, end, fold), np.searchsorted(start, at).astype(np.int64))


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words, with the bounds of each text.

    A text of fewer words has its whole sequence as one shingle; a text without words has none.
    """
    counts = np.diff(words.bounds)
    made = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(made)])
    total = len(words.hash)
    out = np.empty(bounds[-1], U64)
    long = counts >= n
    if long.any():
        runs = np.zeros(total - n + 1, U64)
        for k in range(n):
            runs += words.hash[k : total - n + 1 + k] * _NTH[k]
        # runs that start in a text and end in it
        keep = np.zeros(total + 1, np.int32)
        np.add.at(keep, words.bounds[:-1][long], 1)
        np.add.at(keep, words.bounds[1:][long] - n + 1, -1)
        where = np.zeros(len(out) + 1, np.int32)
        np.add.at(where, bounds[:-1][long], 1)
        np.add.at(where, bounds[1:][long], -1)
        out[np.cumsum(where)[:-1] > 0] = mix(runs[np.cumsum(keep)[: total - n + 1] > 0])
    for k in range(1, n):
        short = np.flatnonzero(counts == k)
        if len(short):
            whole = np.full(len(short), U64(k))
            for i in range(k):
                whole += words.hash[words.bounds[short] + i] * _NTH[i]
            out[bounds[short]] = mix(whole)
    return out, bounds


def pieces(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes of text each, at least one row a run."""
    if not batch.num_rows:
        return
    lengths = np.diff(text_bytes(batch.column(column))[1])
    run = np.cumsum(lengths) // limit
    cuts = np.flatnonzero(np.diff(run)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


#: What operators remember from task to task; it goes when a worker ends a task of another operator.
MEMORIES: list[dict] = []


def trim() -> None:
    """Give freed memory back to the system at the end of a task, since workers go on to other work."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:
        give_back(0)


def release() -> None:
    """``trim``, and forget what other operators remember."""
    for memory in MEMORIES:
        memory.clear()
    trim()


#: Rows that go to a task's Python at once: an Arrow batch lies in the memory of both sides.
BATCH_ROWS = "1000"


def small_batches(spark: SparkSession) -> None:
    """Hand rows with whole texts to Python in batches of ``BATCH_ROWS``, unless the session has a setting of its own."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, "10000") == "10000":  # as it is by default
        spark.conf.set(name, BATCH_ROWS)
