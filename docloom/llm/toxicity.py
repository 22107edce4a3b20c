"""Toxicity scores by logistic regression over hashed n-grams and skip-grams, fitted with FTRL-proximal."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

#: Features are hashed to so many weights.
N_WEIGHTS = 1 << 20
#: About so many labelled rows are learnt from, drawn by a hash of doc_id; a learner gets about so many of them, and goes over them so often.
SAMPLE, PER_LEARNER, EPOCHS = 16_000, 4_000, 4
#: FTRL-proximal: rate of a coordinate alpha / (beta + root of its summed squared gradients), L1 and L2.
ALPHA, BETA, L1, L2 = 0.15, 1.0, 3.0, 0.5
#: Bytes of the word starts that count as features of their own.
PREFIXES = (3, 4, 5)
THRESHOLD = 0.3
_NOT_WORD = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def features(text: str | None) -> np.ndarray:
    """Slots of a whole text's words, word starts, pairs of neighbours and pairs with one word skipped; with repeats."""
    words = (text or "").lower().encode().translate(_NOT_WORD).split()
    n, digest = len(words), xxhash.xxh64_intdigest
    word = np.fromiter(map(digest, words), np.uint64, n)
    parts = [word, *(np.fromiter((digest(w[:k], k) for w in words), np.uint64, n) for k in PREFIXES)]
    for skip, mix in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        parts.append((word[:-skip] * np.uint64(mix) + word[skip:]) * np.uint64(0xFF51AFD7ED558CCD) if n > skip else word[:0])
    return (np.concatenate(parts) >> np.uint64(44)).astype(np.int64)


def learn(texts: list[str | None], labels: np.ndarray, epochs: int = EPOCHS) -> np.ndarray:
    """Weights, the last one a constant, after `epochs` passes of FTRL-proximal in the given order. A feature counts once a text."""
    z, n = np.zeros(N_WEIGHTS + 1), np.zeros(N_WEIGHTS + 1)
    slots = [np.append(np.unique(features(t)), N_WEIGHTS).astype(np.int32) for t in texts]

    def weights(i: np.ndarray | slice) -> np.ndarray:
        return np.where(np.abs(z[i]) <= L1, 0.0, -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(epochs):
        for i, y in zip(slots, labels):
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    return weights(slice(None))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> np.ndarray:
    """Weights learnt from about `sample` labelled documents.

    The sample is dealt to learners by a hash of doc_id, so each learns from a bounded number of texts (of rows that share
    a doc_id, the least text), and their weights are averaged. L1 leaves few that are not zero; only these reach the driver (N_WEIGHTS at most).
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("double").alias("y"))
    n = known.count()
    share, shards = min(1.0, sample / max(1, n)), max(1, math.ceil(min(n, sample) / PER_LEARNER))
    known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = docs.select("doc_id", "text").join(known.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = texts.join(known, "doc_id").withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(shards)))

    def run(shard: pa.Table) -> pa.Table:
        order = np.argsort([xxhash.xxh64_intdigest(str(i)) for i in shard["doc_id"].to_pylist()], kind="stable")
        texts, y = shard["text"].to_pylist(), shard["y"].to_numpy()
        w = learn([texts[i] for i in order], y[order])
        slots = np.flatnonzero(w)
        return pa.table({"slot": slots, "weight": w[slots]})

    found = rows.groupBy("shard").applyInArrow(run, "slot long, weight double").groupBy("slot").agg((F.sum("weight") / shards).alias("weight")).collect()
    weights = np.zeros(N_WEIGHTS + 1)
    for r in found:
        weights[r["slot"]] = r["weight"]
    return weights


def dense(sparse: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    w = np.zeros(N_WEIGHTS + 1)
    w[sparse[0]] = sparse[1]
    return w


def score(text: str | None, w: np.ndarray) -> float:
    i = features(text)
    total = w[np.unique(i[w[i] != 0])].sum() + w[N_WEIGHTS]
    return float(1 / (1 + np.exp(-np.clip(total, -35, 35))))


def scored(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text; null texts count as empty."""
    slots = np.flatnonzero(weights)
    sent = docs.sparkSession.sparkContext.broadcast((slots, weights[slots]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = dense(sent.value)
        for batch in batches:
            scores = pa.array([score(t.as_py(), w) for t in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")


def filtered(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text scores under the threshold, all columns kept. Weights that are all zero, as too few
    labels leave them, know nothing, and reject nothing."""
    if not weights.any():
        return docs
    small_batches(docs.sparkSession)
    slots = np.flatnonzero(weights)
    sent = docs.sparkSession.sparkContext.broadcast((slots, weights[slots]))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = dense(sent.value)
        for batch in batches:
            kept = pa.array([score(t.as_py(), w) < threshold for t in batch.column(at)], pa.bool_())
            yield batch.filter(kept)

    return docs.mapInArrow(run, docs.schema)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def rate(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Each row's toxicity: doc_id, held_out, score, predicted (1 if score >= threshold).

    Learns from labelled rows that are not held out: those whose crc32(doc_id) mod 4 is not 2. A label given twice counts
    as the larger; rows without a label teach nothing. Without any label all scores are one half. Empty and null texts get
    the score of a text without features; rows without an id are scored, not held out. Repeated rows are all returned.
    """
    weights = fit(docs, labels.where(~held_out()))
    out = scored(docs, weights)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
