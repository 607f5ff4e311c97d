"""Language ID in two steps: the language family, then one-versus-one linear SVMs between the languages within it.

Features are hashed byte trigrams of the whole lower-cased text. The SVMs are fitted on a bounded sample: about
PER_LANGUAGE documents of each language, taken by a hash of doc_id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, learnable, read, with_fields
from .linear import char_ngrams, fit, root_share, sigmoid

PER_LANGUAGE, BITS = 400, 12
LETTER = re.compile(r"[^\W\d_]")
# Language codes by family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg",
    "uralic": "fi et hu",
    "semitic": "ar he mt am",
    "indic": "hi bn ur mr gu pa ne si",
    "turkic": "tr az kk uz ky tk",
}


def family(lang: str) -> str:
    """The family of a language tag; an unknown one is a family of its own."""
    code = re.split("[-_]", lang.lower())[0]
    return next((f for f, codes in FAMILIES.items() if code in codes.split()), lang)


def features(text: str | None) -> np.ndarray:
    return root_share(char_ngrams((text or "").lower().encode(), BITS))


class Hierarchy:
    """families: a one-versus-rest SVM for each family; pairs: an SVM for each pair of languages of a family."""

    def __init__(self, langs: list[str], x: np.ndarray, y: np.ndarray):
        self.langs, of = langs, np.array([family(v) for v in langs])
        self.members = {f: np.flatnonzero(of == f) for f in sorted({*of})}
        self.families = list(self.members)
        own = of[y] if len(langs) else y
        sign = lambda hit: np.where(hit, 1, -1).astype(np.float32)
        balance = lambda s: np.where(s > 0, 0.5 / max((s > 0).sum(), 1), 0.5 / max((s < 0).sum(), 1))
        rows = []
        if len(self.families) > 1:
            rows += [fit(x, s := sign(own == f), "hinge", balance(s)) for f in self.families]
        self.pairs = []
        for f in self.families:
            for a, b in combinations(self.members[f], 2):
                pick = (y == a) | (y == b)
                s = sign(y[pick] == a)
                rows.append(fit(x[pick], s, "hinge", balance(s)))
                self.pairs.append((a, b))
        self.weights = np.array(rows, np.float32).reshape(len(rows), x.shape[1] + 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not text or not LETTER.search(text):
            return "und", 0.0
        margin = self.weights[:, :-1] @ features(text) + self.weights[:, -1]
        n = len(self.families) if len(self.families) > 1 else 0
        chosen, sure = self.families[0], 1.0
        if n:
            share = sigmoid(3 * margin[:n])
            chosen, sure = self.families[int(share.argmax())], float(share.max() / share.sum())
        votes = {int(m): 0.0 for m in self.members[chosen]}
        for (a, b), d in zip(self.pairs, margin[n:], strict=True):
            if a in votes and b in votes:
                p = float(sigmoid(3 * d))
                votes[int(a)] += p
                votes[int(b)] += 1 - p
        best = max(votes, key=lambda m: (votes[m], -m))
        return self.langs[best], sure * (votes[best] / (len(votes) - 1) if len(votes) > 1 else 1.0)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(x.as_py()).astype(np.float16).tobytes() for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(found, pa.binary())], ["doc_id", "lang", "x"])


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Hierarchy:
    """Fit on documents with a lang, a text and a learnable doc_id (of any type); the driver gets features of the sample, no text.

    It also gets the distinct values of lang and their counts: a model between languages holds one row for each of them.
    """
    docs = docs.select("doc_id", "lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & learnable())
    sizes = {r[0]: r[1] for r in docs.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Hierarchy([], np.zeros((0, 1 << BITS), np.float32), np.zeros(0, np.int64))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1_000_000))
    share = F.create_map(*[F.lit(v) for lang in langs for v in (lang, min(1_000_000, 1 + 1_000_000 * per_language // sizes[lang]))])[F.col("lang")]
    sample = docs.where(draw < share).orderBy(draw, "doc_id", "lang", "text").limit(2 * per_language * len(langs))
    rows = sample.mapInArrow(_features, with_fields(sample.select("doc_id"), "lang string, x binary")).orderBy("doc_id", "lang", "x").collect()
    x = np.array([np.frombuffer(r.x, np.float16) for r in rows], np.float32).reshape(len(rows), 1 << BITS)
    there = sorted({r.lang for r in rows})
    return Hierarchy(there, x, np.array([there.index(r.lang) for r in rows], np.int64))


def _predict(batches: Iterator[pa.RecordBatch], model: Hierarchy) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [model.predict(x.as_py()) for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], [*batch.schema.names, "lang_pred", "lang_score"])


def predict(docs: DataFrame, model: Hierarchy) -> DataFrame:
    """docs with lang_pred and lang_score; `und` and 0 where the text is null or has no letter. All rows and columns stay."""
    docs = docs.drop("lang_pred", "lang_score")
    return docs.mapInArrow(partial(_predict, model=model), with_fields(docs, "lang_pred string, lang_score double"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; `und` and score 0 where the text is null, empty or without letters."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs)
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
