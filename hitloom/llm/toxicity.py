"""Toxicity by a factorization machine over hashed terms.

Terms are the distinct words of a text, lower-cased and without outer punctuation, and the words' first PREFIXES
letters, all hashed; the machine has a weight for each term and a short vector for each, whose inner products weigh
pairs of terms. It is fitted on a bounded sample of labelled documents (PER_CLASS of each class) and on the TERMS
hashed terms that separate the classes best there, of those whose shares differ by MIN_Z standard errors or more.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, read, with_fields
from .linear import labelled, sigmoid

PER_CLASS, TERMS, FACTORS, THRESHOLD = 3000, 1024, 8, 0.7
MIN_Z = 4
PREFIXES = (4, 5, 6)
BUCKETS = 1 << 20
CACHE = 300_000
PUNCTUATION = ".,;:!?\"'()[]{}*#&%$-–—…«»"


class Terms(dict):
    """word -> its hashed terms, or their places in the model if `index` is given; emptied at CACHE words."""

    def __init__(self, index: dict[int, int] | None = None):
        self.index = index

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE:
            self.clear()
        core = word.strip(PUNCTUATION)
        parts = ([core] if core else []) + [core[:k] + "~" for k in PREFIXES if len(core) >= k]
        out = tuple(zlib.crc32(p.encode()) % BUCKETS for p in parts)
        if self.index is not None:
            out = tuple(self.index[t] for t in out if t in self.index)
        self[word] = out
        return out

    def of(self, text: str | None) -> np.ndarray:
        found = set(chain.from_iterable(map(self.__getitem__, set(text.lower().split())))) if text else ()
        return np.array(sorted(found), np.int64)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    terms = Terms()
    for batch in batches:
        found = [terms.of(x.as_py()).astype(np.int32).tobytes() for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(found, pa.binary())], ["doc_id", "y", "terms"])


class FactorizationMachine:
    def __init__(self, terms: np.ndarray, bias: float, weights: np.ndarray, vectors: np.ndarray):
        self.terms, self.bias, self.weights, self.vectors = terms, bias, weights, vectors

    def score(self, found: np.ndarray) -> float:
        """found: places of the text's terms in the model."""
        v = self.vectors[found]
        pairs = (v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum() / 2
        return float(sigmoid(self.bias + self.weights[found].sum() + pairs))


def fit_machine(rows: list[tuple[np.ndarray, int]], steps: int = 400, rate: float = 0.03, penalty: float = 2e-4) -> FactorizationMachine:
    """rows: (terms, label 0 or 1). With one class alone, every text scores as that class; without rows, 0."""
    y = np.array([r[1] for r in rows], np.float32)
    if not len(y) or y.min() == y.max():
        return FactorizationMachine(np.array([], np.int64), 30.0 if len(y) and y[0] else -30.0, np.zeros(0), np.zeros((0, FACTORS)))
    size = [np.bincount(np.concatenate([t for t, label in rows if label == c] or [[]]).astype(np.int64), minlength=BUCKETS) for c in (0, 1)]
    n = [(y == c).sum() for c in (0, 1)]
    share = [s / k for s, k in zip(size, n, strict=True)]
    pooled = (size[0] + size[1]) / len(y)
    spread = 1 / n[0] + 1 / n[1]
    z = (np.abs(share[1] - share[0]) - spread / 2) / np.sqrt(pooled * (1 - pooled) * spread + 1e-12)  # with Yates's correction
    terms = np.sort(np.argsort(-z, kind="stable")[:TERMS])
    terms = terms[z[terms] >= MIN_Z]
    x = np.zeros((len(y), len(terms)), np.float32)
    for i, (t, _) in enumerate(rows):
        at = np.searchsorted(terms, t)
        hit = at[np.isin(t, terms)]
        x[i, hit] = 1
    rng = np.random.default_rng(7)
    p = [np.zeros(1, np.float32), np.zeros(len(terms), np.float32), rng.normal(0, 0.02, (len(terms), FACTORS)).astype(np.float32)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    balance = np.where(y == 1, 0.5 / n[1], 0.5 / n[0]).astype(np.float32)
    for t in range(1, steps + 1):
        s = x @ p[2]
        out = p[0] + x @ p[1] + (s**2 - x @ p[2] ** 2).sum(axis=1) / 2
        g = balance * (sigmoid(out) - y)
        gx = g @ x
        grads = [np.array([g.sum()], np.float32), gx + penalty * p[1], x.T @ (g[:, None] * s) - gx[:, None] * p[2] + penalty * p[2]]
        for i, grad in enumerate(grads):
            m[i], v[i] = 0.9 * m[i] + 0.1 * grad, 0.99 * v[i] + 0.01 * grad**2
            p[i] = p[i] - rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.99**t)) + 1e-8)
    return FactorizationMachine(terms, float(p[0][0]), p[1], p[2])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> FactorizationMachine:
    """Fit on the labels' learnable part; the driver gets hashed terms of 2 * per_class documents at most, no text.

    doc_id may have any type. Of labels that repeat an id the greatest value counts, of documents the least text.
    """
    sample = labelled(docs, labels, "toxic", per_class)
    rows = sample.mapInArrow(_terms, with_fields(sample.select("doc_id"), "y int, terms binary")).orderBy("doc_id").collect()
    return fit_machine([(np.frombuffer(r.terms, np.int32), r.y) for r in rows])


def _score(batches: Iterator[pa.RecordBatch], model: FactorizationMachine) -> Iterator[pa.RecordBatch]:
    terms = Terms({int(t): i for i, t in enumerate(model.terms)})
    for batch in batches:
        score = [model.score(terms.of(x.as_py())) for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*batch.schema.names, "toxicity_score"])


def score(docs: DataFrame, model: FactorizationMachine) -> DataFrame:
    """docs with toxicity_score (0 to 1). Null and empty texts score as a text without terms; all columns and rows stay.

    A column of that name is replaced. Texts with the same terms tie.
    """
    docs = docs.drop("toxicity_score")
    return docs.mapInArrow(partial(_score, model=model), with_fields(docs, "toxicity_score double"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score; null and empty texts get that of a text without terms, repeated rows equal scores."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), F.col("toxicity_score").alias("score"),
        (F.col("toxicity_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
