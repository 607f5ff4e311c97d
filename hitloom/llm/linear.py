"""Hashed n-gram features, bounded labelled samples and small linear models, for the text classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import learnable

BLOCK = 1 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def bucket_counts(hashes: np.ndarray, bits: int) -> np.ndarray:
    """How many of the 64-bit hashes fall into each of 2**bits buckets."""
    return np.bincount(((hashes * MIX) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)


def char_ngrams(data: bytes, bits: int) -> np.ndarray:
    """Counts of the hashed byte trigrams of a text between two blanks, a block at a time."""
    data = b" " + data + b" "
    out = np.zeros(1 << bits, np.int64)
    for at in range(0, max(len(data) - 2, 0), BLOCK):
        x = np.frombuffer(data[at : at + BLOCK + 2], np.uint8).astype(np.uint64)
        out += bucket_counts(x[:-2] | x[1:-1] << np.uint64(8) | x[2:] << np.uint64(16), bits)
    return out


def root_share(counts: np.ndarray) -> np.ndarray:
    """Square roots of shares: a vector of length one, or zero."""
    return np.sqrt(counts / max(counts.sum(), 1)).astype(np.float32)


def one_label(labels: DataFrame, target: str) -> DataFrame:
    """doc_id, y of the learnable labels: the greatest value of a doc_id that repeats; null ids and values are left out."""
    rows = labels.select("doc_id", F.col(target).cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & learnable())
    return rows.groupBy("doc_id").agg(F.max("y").alias("y"))


def sample_labels(labels: DataFrame, target: str, per_class: int) -> DataFrame:
    """doc_id, y: at most per_class learnable labels of each value 0 and 1, the first ones by a hash of doc_id."""
    rows = one_label(labels, target)
    first = [rows.where(F.col("y") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for v in (0, 1)]
    return first[0].unionByName(first[1])


def labelled(docs: DataFrame, labels: DataFrame, target: str, per_class: int) -> DataFrame:
    """doc_id, text, y of the sampled labels' documents; of a doc_id that repeats, the least text (nulls first)."""
    sample = F.broadcast(sample_labels(labels, target, per_class))  # at most 2 * per_class rows
    return docs.select("doc_id", "text").join(sample, "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct("text")).alias("one")).select("doc_id", "one.text", "y")


def class_sizes(labels: DataFrame, target: str) -> dict[int, int]:
    """How many learnable labels each value has."""
    rows = one_label(labels, target).where("y in (0, 1)")
    return {r[0]: r[1] for r in rows.groupBy("y").count().collect()}


def fit(x: np.ndarray, y: np.ndarray, loss: str, weight: np.ndarray | None = None, penalty: float = 1e-4, steps: int = 300, rate: float = 0.3) -> np.ndarray:
    """Weights and a last bias of a linear model for y in {-1, 1}, by Adam on the whole sample; loss: logistic or hinge (squared)."""
    weight = np.ones(len(y)) if weight is None else weight
    weight = (weight / weight.sum()).astype(np.float32)
    w, m, v = (np.zeros(x.shape[1] + 1, np.float32) for _ in range(3))
    for t in range(1, steps + 1):
        margin = y * (x @ w[:-1] + w[-1])
        slope = -1 / (1 + np.exp(np.clip(margin, -30, 30))) if loss == "logistic" else -2 * np.maximum(0, 1 - margin)
        g = (weight * slope * y).astype(np.float32)
        grad = np.append(g @ x + penalty * w[:-1], g.sum()).astype(np.float32)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
