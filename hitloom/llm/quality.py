"""Quality rules: counts of words, symbols, lines and repeats, and a calibrated logistic regression on hashed n-grams.

The regression sees hashed words, word pairs and byte trigrams. It is fitted on a bounded sample of labelled documents
(PER_CLASS of each class) and calibrated on a part of the sample that it didn't see, weighted to the classes' real shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, with_fields
from .linear import bucket_counts, char_ngrams, class_sizes, fit, labelled, root_share, sigmoid

PER_CLASS, CHAR_BITS, WORD_BITS = 1200, 11, 12
MIN_WORDS, MAX_REPEAT_PERCENT, MIN_QUALITY = 10, 20, 0.5
SYMBOLS = [c.encode() for c in "#*$%&|<>"]
WINDOW = 5
ODD = np.uint64(0xD6E8FEB86659FD93)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def repeat_words(h: np.ndarray, window: int = WINDOW) -> int:
    """How many words lie in windows that the text has twice or more."""
    n = len(h) - window + 1
    if n < 2:
        return 0
    acc = np.zeros(n, np.uint64)
    for i in range(window):
        acc = (acc ^ h[i : i + n]) * ODD
        acc ^= acc >> np.uint64(32)
    order = np.argsort(acc, kind="stable")
    same = acc[order][1:] == acc[order][:-1]
    again = np.zeros(n, bool)
    again[order[1:]] = same
    again[order[:-1]] |= same
    edge = np.zeros(len(h) + 1, np.int64)
    edge[:n] += again
    edge[window:] -= again
    return int((np.cumsum(edge[:-1]) > 0).sum())


def duplicate_lines(data: bytes) -> int:
    """How many lines with a word equal an earlier line of the text."""
    lines = [x for x in data.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def judge(data: bytes | None) -> tuple[list[int], np.ndarray]:
    """The five counts and the features of a UTF-8 text; a null text has no words."""
    data = data or b""
    words = data.split()
    h = word_hashes(words)
    counts = [len(words), len(b"".join(words).decode()), sum(map(data.count, SYMBOLS)), duplicate_lines(data), repeat_words(h)]
    grams = bucket_counts(h, WORD_BITS) + bucket_counts((h[:-1] * ODD) ^ h[1:], WORD_BITS)
    return counts, np.concatenate([root_share(char_ngrams(data, CHAR_BITS)), root_share(grams)])


class Quality:
    """A logistic regression and its calibration; without both classes, every text has the prior of what there is (1 if nothing)."""

    def __init__(self, x: np.ndarray, y: np.ndarray, sizes: dict[int, int]):
        self.weights, self.scale = None, (0.0, 30.0 if sizes.get(1) or not sizes.get(0) else -30.0)
        if not len(y) or y.min() == y.max():
            return
        sign = np.where(y == 1, 1, -1).astype(np.float32)
        fold = np.arange(len(y)) % 4 == 3
        if len({*sign[~fold]}) < 2 or len({*sign[fold]}) < 2:
            fold = np.zeros(len(y), bool)
        part = ~fold
        balance = np.where(sign > 0, 0.5 / (sign[part] > 0).sum(), 0.5 / (sign[part] < 0).sum())
        self.weights = fit(x[part], sign[part], "logistic", balance[part])
        part = fold if fold.any() else part
        margin = x[part] @ self.weights[:-1] + self.weights[-1]
        real = np.where(sign[part] > 0, sizes[1] / (sign[part] > 0).sum(), sizes[0] / (sign[part] < 0).sum())
        a, b = fit(margin[:, None] / 10, sign[part], "logistic", real, penalty=1e-3, steps=500, rate=0.1)
        self.scale = (float(a) / 10, float(b))

    def score(self, x: np.ndarray) -> float:
        margin = 0.0 if self.weights is None else float(self.weights[:-1] @ x + self.weights[-1])
        return float(sigmoid(self.scale[0] * margin + self.scale[1]))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [judge(x.as_py())[1].astype(np.float16).tobytes() for x in batch.column("data")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(found, pa.binary())], ["doc_id", "y", "x"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Quality:
    """Fit on the labels' learnable part; the driver gets hashed features of 2 * per_class documents at most, no text.

    doc_id may have any type. Of labels that repeat an id the greatest value counts, of documents the least text.
    """
    sample = labelled(docs, labels, "quality", per_class).select("doc_id", "y", F.col("text").cast("binary").alias("data"))
    rows = sample.mapInArrow(_features, with_fields(sample.select("doc_id"), "y int, x binary")).orderBy(F.xxhash64("doc_id", F.lit("fold")), "doc_id").collect()
    width = (1 << CHAR_BITS) + (1 << WORD_BITS)
    x = np.empty((len(rows), width), np.float32)
    for i, r in enumerate(rows):
        x[i] = np.frombuffer(r.x, np.float16)
    return Quality(x, np.array([r.y for r in rows], np.int64), class_sizes(labels, "quality"))


def _judge(batches: Iterator[pa.RecordBatch], model: Quality) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, score = [], []
        for data in batch.column("data"):
            c, x = judge(data.as_py())
            counts.append(c)
            score.append(model.score(x))
        columns = np.array(counts, np.int64).reshape(-1, len(COUNTS))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(columns[:, i]) for i in range(len(COUNTS))), pa.array(score, pa.float64())], ["doc_id", *COUNTS, "quality_score"])


def assess(docs: DataFrame, model: Quality) -> DataFrame:
    """doc_id, the five counts, quality_score, base_failed and kept of each document.

    Null and empty texts have no words, so they fail the base rules. Repeated rows stay; extra columns are left out.
    """
    docs = docs.select("doc_id", F.col("text").cast("binary").alias("data"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.mapInArrow(partial(_judge, model=model), f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, quality_score double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("quality_score") >= MIN_QUALITY))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts and verdicts; a null or empty text has no words and fails the base rules."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return assess(docs, train(docs, read(spark, sf_dir, "labels")))
