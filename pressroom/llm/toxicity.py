"""Toxicity by a factorization machine over hashed terms.

Terms of a document are its distinct words and their prefixes of 4, 5 and 6 bytes (so an unseen ending of a known stem counts), as
64-bit hashes. The model is bias + sum of term weights + interactions of all pairs of terms through short factor vectors, so
that two terms can weigh together what neither does alone. It is fitted on a bounded sample of labelled documents, read off by
label and hash of the id. A term takes part if the sample shows that it matters: alone, by a share of label 1 that stands out, or in a pair, by
what all such terms together leave unexplained where both terms occur. Pairs are looked at among the ``FREQUENT`` terms of most documents and the
terms that stand out alone; rarer pairs have too few documents in the sample to tell. Scoring reads every whole text.

Documents are counted by term in Spark, so the one task that fits gets no other terms than these, however long the documents are.

A null or blank text has no terms and gets the score of the bias. Rows with null labels or a null doc_id are not learned from; a document
with several labels counts as toxic if any says so. Repeated rows are scored alike. Without any labelled row, or with one label only,
the score is the share of that label, or 0. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.llm.words import U64, mix, pieces, release, span_hashes, split_words
from pressroom.session import bounded_broadcast, materialize

#: Documents of each label that are learned from, at most: those with the smallest hash of their id.
PER_LABEL = 6000
PREFIXES = (4, 5, 6)
FACTORS, EPOCHS, RATE, DECAY, SEED = 4, 200, 0.15, 1e-4, 5
#: A term needs so many documents of the sample, and so large a deviation (in standard errors) from the share of the label.
LEAST_DOCS, LEAST_Z = 3, 5.0
#: Terms of most documents whose pairs are looked at; the deviation a pair needs; terms looked at in pairs at most; documents taken at once.
FREQUENT, PAIR_Z, PAIRED, TOGETHER = 1024, 6.5, 2048, 512
_LUT_BITS = 22


def document_terms(column: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, term) of the distinct terms of each text, ordered; with ``wanted`` (ascending) only those terms."""
    w = split_words(column)
    text = np.repeat(np.arange(len(w.bounds) - 1), np.diff(w.bounds))
    parts = [w.hash]
    owners = [text]
    for k, size in enumerate(PREFIXES):
        longer = w.end - w.start > size
        parts.append(mix(span_hashes(w.data, w.start[longer], w.start[longer] + size, True) + U64(k + 1)))
        owners.append(text[longer])
    terms, owners = np.concatenate(parts), np.concatenate(owners)
    if wanted is not None:
        if not len(wanted):
            return owners[:0], terms[:0]
        maybe = np.zeros(1 << _LUT_BITS, bool)  # skips nearly all terms without a search
        maybe[wanted >> U64(64 - _LUT_BITS)] = True
        near = maybe[terms >> U64(64 - _LUT_BITS)]
        terms, owners = terms[near], owners[near]
        hit = wanted[np.minimum(np.searchsorted(wanted, terms), len(wanted) - 1)] == terms
        terms, owners = terms[hit], owners[hit]
    order = np.lexsort((terms, owners))
    terms, owners = terms[order], owners[order]
    first = np.ones(len(terms), bool)
    first[1:] = (terms[1:] != terms[:-1]) | (owners[1:] != owners[:-1])
    return owners[first], terms[first]


@dataclass
class Model:
    """Ascending terms with their weights and factors."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def score(self, rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        """Probability of label 1 for texts 0 to n, from their distinct terms (all of them known, ordered by text)."""
        at = np.searchsorted(self.terms, terms)
        linear = np.bincount(rows, self.weights[at], n)
        pairs = np.zeros(n)
        for f in self.factors.T:
            pairs += np.bincount(rows, f[at], n) ** 2 - np.bincount(rows, f[at] ** 2, n)
        return 1 / (1 + np.exp(-np.clip(self.bias + linear + pairs / 2, -500, 500)))


def deviation(count: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """How far the share of label 1 among a term's documents is from that of the sample, in standard errors."""
    return (toxic - count * share) / np.sqrt(np.maximum(count * share * (1 - share), 1e-12))


def _steps(rows: np.ndarray, at: np.ndarray, known: int, labels: np.ndarray, weight: np.ndarray, factors: int, epochs: int = EPOCHS) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Bias, weights, factors and error of each document, after adaptive steps on the whole sample."""
    n = len(labels)
    rng = np.random.default_rng(SEED)
    bias, weights, vectors = 0.0, np.zeros(known), rng.normal(0, 0.01, (known, factors))
    seen, seen_bias = np.zeros((known, factors + 1)) + 1e-8, 1e-8
    for _ in range(epochs):
        raw = bias + np.bincount(rows, weights[at], n)
        if factors:
            sums = np.stack([np.bincount(rows, f[at], n) for f in vectors.T], 1)
            raw += ((sums**2).sum(1) - np.bincount(rows, (vectors[at] ** 2).sum(1), n)) / 2
        error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels
        weighed = error * weight
        of_pair = weighed[rows]
        gradient = np.empty_like(seen)
        gradient[:, 0] = np.bincount(at, of_pair, known) + DECAY * weights
        for f in range(factors):
            gradient[:, f + 1] = np.bincount(at, of_pair * (sums[rows, f] - vectors[at, f]), known) + DECAY * vectors[:, f]
        seen += gradient**2
        seen_bias += weighed.sum() ** 2
        step = RATE * gradient / np.sqrt(seen)
        weights, vectors = weights - step[:, 0], vectors - 0.1 * step[:, 1:]
        bias -= RATE * weighed.sum() / np.sqrt(seen_bias)
    return float(bias), weights, vectors, error


def paired_terms(rows: np.ndarray, at: np.ndarray, known: int, error: np.ndarray) -> np.ndarray:
    """Which of the terms are in a pair whose documents are labelled otherwise than ``error`` leaves room for."""
    error = error - error.mean()
    both, spread = (np.zeros((known, known), np.float32) for _ in range(2))
    starts = np.searchsorted(rows, np.arange(0, len(error) + TOGETHER, TOGETHER))
    for i, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
        own = error[i * TOGETHER : (i + 1) * TOGETHER].astype(np.float32)[:, None]
        x = np.zeros((len(own), known), np.float32)
        x[rows[a:b] - i * TOGETHER, at[a:b]] = 1
        both += x.T @ (x * own)
        spread += x.T @ (x * own**2)
    z = np.abs(both) / np.sqrt(np.maximum(spread, 1e-6))  # at most the root of the number of documents
    np.fill_diagonal(z, 0)
    return np.flatnonzero((z >= PAIR_Z).any(1))


def fit(rows: np.ndarray, terms: np.ndarray, labels: np.ndarray) -> Model:
    """Factorization machine on distinct (text, term) pairs ordered by text; a rarer label weighs more, by the root of its rarity."""
    none = np.zeros(0)
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.0
        return Model(700.0 * np.sign(share - 0.5), none.astype(U64), none, np.zeros((0, FACTORS)))
    n = len(labels)

    def only(wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keep = np.isin(terms, wanted)
        return rows[keep], np.searchsorted(wanted, terms[keep])

    found, inverse, count = np.unique(terms, return_inverse=True, return_counts=True)
    z = np.abs(deviation(count, np.bincount(inverse, labels[rows], len(found)), labels.mean()))
    alone = (count >= LEAST_DOCS) & (z >= LEAST_Z)
    own, at = only(found[alone])
    _, _, _, error = _steps(own, at, int(alone.sum()), labels, np.full(n, 1 / n), 0, EPOCHS // 2)
    frequent = np.zeros(len(found), bool)
    frequent[np.lexsort((found, -count))[:FREQUENT]] = True
    clearest = np.lexsort((found, -np.where(alone, z, -1)))[: PAIRED - FREQUENT]
    frequent[clearest] |= alone[clearest]
    pool = found[frequent & (count >= LEAST_DOCS)]
    own, at = only(pool)
    known = np.union1d(found[alone], pool[paired_terms(own, at, len(pool), error)])
    own, at = only(known)
    balance = np.where(labels == 1, np.sqrt(n / labels.sum()), np.sqrt(n / (1 - labels).sum())) / n
    bias, weights, factors, _ = _steps(own, at, len(known), labels, balance, FACTORS)
    return Model(bias, known, weights, factors)


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """Fit on at most PER_LABEL documents of each label among the rows that ``learn`` (on ``doc_id``) holds for.

    Of their terms those that can take part come together in one task, and nothing else of the corpus; the model that returns is a table of the chosen terms.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(learn)
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.join(docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct(), "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), "doc_id"]
    one, other = (known.where(F.col("toxic") == v).orderBy(*order).limit(PER_LABEL) for v in (1, 0))
    chosen = materialize(one.unionByName(other).withColumnRenamed("doc_id", "_id"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(bounded_broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "toxic")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                owner, terms = document_terms(piece.column("text"))
                cuts = np.searchsorted(owner, np.arange(piece.num_rows + 1))
                packed = [terms[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("toxic"), pa.array(packed, pa.binary())], ["doc_id", "toxic", "terms"])
        release()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                packed = [np.frombuffer(x, U64) for x in part.column("terms").to_pylist()]
                toxic = np.repeat(part.column("toxic").to_numpy(), [len(x) for x in packed])
                found, inverse, count = np.unique(np.concatenate([np.zeros(0, U64), *packed]), return_inverse=True, return_counts=True)
                sums = np.bincount(inverse, toxic, len(found)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(count), pa.array(sums)], ["term", "n", "toxic"])
        release()

    packed = materialize(rows.mapInArrow(features, "doc_id bigint, toxic int, terms binary").dropDuplicates(["doc_id"]))
    size, share = packed.agg(F.count("*"), F.avg("toxic")).first()
    if not size:
        return fit(np.zeros(0, int), np.zeros(0, U64), np.zeros(0))
    counts = packed.mapInArrow(counted, "term bigint, n bigint, toxic bigint").groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    counts = materialize(counts.where(F.col("n") >= LEAST_DOCS))
    z = F.abs(F.col("toxic") - F.col("n") * share) / F.sqrt(F.greatest(F.col("n") * F.lit(share * (1 - share)), F.lit(1e-12)))
    wanted = counts.where(z >= LEAST_Z - 1e-6).select("term").union(counts.orderBy(F.desc("n"), "term").select("term").limit(FREQUENT))
    chosen_terms = np.unique(wanted.toArrow().column("term").to_numpy().view(U64))  # terms of the bounded sample that stand out

    def narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x in batch.column("terms"):
                own = np.frombuffer(x.as_py(), U64)
                kept.append(own[np.isin(own, chosen_terms, assume_unique=True)].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(kept, pa.binary())], ["doc_id", "toxic", "terms"])

    model_schema = "bias double, terms binary, weights binary, factors binary"

    def learned(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")  # the same model whatever order rows come in
        packed = [np.frombuffer(x, U64) for x in table.column("terms").to_pylist()]
        owner = np.repeat(np.arange(len(packed)), [len(x) for x in packed])
        m = fit(owner, np.concatenate([np.zeros(0, U64), *packed]), table.column("toxic").to_numpy().astype(float))
        release()
        return pa.table({"bias": [m.bias], "terms": pa.array([m.terms.tobytes()], pa.binary()), "weights": pa.array([m.weights.tobytes()], pa.binary()), "factors": pa.array([m.factors.tobytes()], pa.binary())})

    small = packed.mapInArrow(narrowed, "doc_id bigint, toxic int, terms binary")
    m = small.withColumn("sample", F.lit(1)).groupBy("sample").applyInArrow(learned, model_schema).first()  # one row, from the bounded sample
    return Model(m["bias"], np.frombuffer(m["terms"], U64), np.frombuffer(m["weights"]), np.frombuffer(m["factors"]).reshape(-1, FACTORS))


def scored(docs: DataFrame, model: Model, keep: list[str], name: str = "score") -> DataFrame:
    """The columns ``keep`` of every row, and the model's probability that the text is toxic."""
    narrow = docs.select(F.col("text").cast("string").alias("_text"), *keep)
    schema = ", ".join([*(f"`{n}` {t}" for n, t in narrow.dtypes if n != "_text"), f"`{name}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "_text", 1 << 20):
                owner, terms = document_terms(piece.column("_text"), model.terms)
                score = model.score(owner, terms, piece.num_rows)
                columns = [piece.column(c) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], [*keep, name])
        release()

    return narrow.mapInArrow(run, schema)
