"""Benchmark decontamination by CGK embedding and bit-sampling LSH, with exact edit verification.

Texts and benchmark items are sequences of lower-cased words. The CGK random walk reads a window of words: at step j it
writes the word under its pointer, and moves on if a random bit of (j, word) is set. Windows at a small edit distance
then agree at most steps, as the walks fall into step again after an edit. A repetition samples SAMPLED of the steps
as its bucket key; windows and items that share a bucket in any of REPEATS repetitions are candidates, and the edit
distance in words decides: at most `budget` of the item's words, 1 - SIMILARITY of them.

REPEATS follows from the target: where walks agree in a share s of their steps, a repetition finds the pair with
probability s ** SAMPLED, so RECALL takes log(1 - RECALL) / log(1 - s ** SAMPLED) of them; AGREE is the share at the
full budget of edits.

Windows are as long as an item's length class, and are cut where an anchor of the item stands: its budget + 1 (ANCHORS at least) rarest
distinct words, or all of them if there are fewer. An edit takes away one word of the item at most, so every match
within the budget keeps an anchor in one of its places, and no place that can match is left out. Items come in blocks
of about BLOCK, each of which passes over the documents once.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import cut, read

SIMILARITY, RECALL, AGREE, SAMPLED, BLOCK = 0.8, 0.99, 0.45, 3, 5000
ANCHORS = 6
REPEATS = math.ceil(math.log(1 - RECALL) / math.log(1 - AGREE**SAMPLED))
WINDOWS = 1 << 14  # windows that are embedded at once


def budget(m: int) -> int:
    """How many of the words of an item of m words may be edited."""
    return int((1 - SIMILARITY) * m + 1e-9)


def length_class(m: int) -> int:
    """The window length for an item of m words: m up to 8 words, then the largest of 8, 10, 12, 15 ... not above m."""
    size = float(m if m < 8 else 8)
    while size * 1.25 <= m and m >= 8:
        size *= 1.25
    return int(size)


def word_ids(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


class Walks:
    """REPEATS walks over windows of one length: random bits by step, and the sampled steps."""

    def __init__(self, size: int, seed: int = 11):
        rng = np.random.default_rng([seed, size])
        self.size, self.steps = size, 2 * size
        self.salt = rng.integers(1, 2**63, (self.steps, REPEATS), dtype=np.uint64) | np.uint64(1)
        self.sampled = np.zeros((self.steps, REPEATS), bool)
        for r in range(REPEATS):
            self.sampled[rng.choice(self.steps, min(SAMPLED, self.steps), replace=False), r] = True

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """windows: rows of word ids (0: past the end) -> a bucket key for each row and repetition."""
        n, width = windows.shape
        at = np.zeros((n, REPEATS), np.int64)
        key = np.broadcast_to(np.arange(REPEATS, dtype=np.uint64), (n, REPEATS)).copy()
        rows = np.arange(n)[:, None]
        for j in range(self.steps):
            word = np.where(at < width, windows[rows, np.minimum(at, width - 1)], np.uint64(0))
            key = np.where(self.sampled[j], (key ^ word) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(j), key)
            at += (((word ^ self.salt[j]) * self.salt[j]) >> np.uint64(63)).astype(np.int64)
        return key


def edit_span(item: list[str], region: list[str]) -> tuple[int, int, int]:
    """The least edit distance in words of item to any part of region, and that part's start and length."""
    m, n = len(item), len(region)
    best = [(0, j) for j in range(n + 1)]  # (distance, start) by end
    for i in range(1, m + 1):
        word, row = item[i - 1], [(i, 0)]
        for j in range(1, n + 1):
            d, s = best[j - 1]
            row.append(min((d + (word != region[j - 1]), s), (best[j][0] + 1, best[j][1]), (row[j - 1][0] + 1, row[j - 1][1])))
        best = row
    d, s, end = min((d, s, j) for j, (d, s) in enumerate(best))
    return d, s, end - s


class Benchmark:
    """A block of items: anchors to cut windows at, and buckets of the items' own windows."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [(i, t.lower().split()) for i, t in items if t and t.split()]
        common = Counter(w for _, words in self.items for w in words)
        self.anchors: dict[str, set[tuple[int, int]]] = defaultdict(set)
        self.walks, self.buckets = {}, {}
        of_size: dict[int, list[int]] = defaultdict(list)
        for k, (_, words) in enumerate(self.items):
            size = length_class(len(words))
            of_size[size].append(k)
            rare = set(sorted(set(words), key=lambda w: (common[w], -len(w), w))[: max(ANCHORS, budget(len(words)) + 1)])
            for p, w in enumerate(words):
                if w in rare:
                    self.anchors[w].add((size, p))
        for size, members in of_size.items():
            self.walks[size] = walks = Walks(size)
            keys = walks.keys(np.array([word_ids(self.items[k][1][:size]) for k in members]))
            self.buckets[size] = buckets = defaultdict(set)
            for k, row in zip(members, keys.tolist(), strict=True):
                for key in row:
                    buckets[key].add(k)

    def candidates(self, texts: list[list[str]]) -> set[tuple[int, int, int]]:
        """(text, item, start) whose windows share a bucket."""
        cuts: dict[int, set[tuple[int, int]]] = defaultdict(set)
        anchors = self.anchors
        for t, words in enumerate(texts):
            for at in [i for i, w in enumerate(words) if w in anchors]:
                for size, p in anchors[words[at]]:
                    cuts[size].add((t, max(0, at - p)))
        found = set()
        for size, places in cuts.items():
            places, buckets = sorted(places), self.buckets[size]
            for lo in range(0, len(places), WINDOWS):
                part = places[lo : lo + WINDOWS]
                windows = np.zeros((len(part), size), np.uint64)
                for row, (t, s) in enumerate(part):
                    ids = word_ids(texts[t][s : s + size])
                    windows[row, : len(ids)] = ids
                keys = self.walks[size].keys(windows)
                hit = np.isin(keys, np.fromiter(buckets, np.uint64, len(buckets)))
                for row in np.flatnonzero(hit.any(axis=1)).tolist():
                    for key in keys[row, hit[row]].tolist():
                        found |= {(part[row][0], k, part[row][1]) for k in buckets[key]}
        return found

    def leaks(self, texts: list[list[str]]) -> dict[int, dict[int, tuple[int, int, int]]]:
        """text -> item -> (distance, start, words) of its best verified match."""
        out: dict[int, dict[int, tuple[int, int, int]]] = defaultdict(dict)
        for t, k, start in sorted(self.candidates(texts)):
            item = self.items[k][1]
            most = budget(len(item))
            if out[t].get(k, (1,))[0] == 0:
                continue
            lo = max(0, start - most)
            d, s, n = edit_span(item, texts[t][lo : start + len(item) + most])
            if d <= most:
                out[t][k] = min(out[t].get(k, (d, lo + s, n)), (d, lo + s, n))
        return out


def _leaks(batches: Iterator[pa.RecordBatch], items: list[tuple[int, str]], kind: pa.DataType, only: bool) -> Iterator[pa.RecordBatch]:
    """The batches with `leaks`; only: without the rows that have none, and without text."""
    model = Benchmark(items)
    for whole in batches:
        for at in range(0, max(1, whole.num_rows), 1000):
            batch = whole.slice(at, 1000)
            texts = [(x.as_py() or "").lower().split() for x in batch.column("text")]
            found = model.leaks(texts)
            rows = [[{"item_id": model.items[k][0], "distance": d, "start_word": s, "n_words": n} for k, (d, s, n) in sorted(found.get(t, {}).items())] for t in range(len(texts))]
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], [*batch.schema.names, "leaks"])
            yield out.filter(pa.array([bool(r) for r in rows], pa.bool_())).drop_columns(["text"]) if only else out


def find_leaks(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """docs with `leaks`: for each benchmark item found in the text its item_id, distance, start_word and n_words (best match).

    Items without words match nothing, an item whose item_id is null is found like any other, and equal items count
    once; item_id may have any type. Null and empty texts have no leaks. All rows and other columns stay, but for one
    called leaks. A benchmark of several blocks takes a pass for each, and the few rows found are joined to docs.
    """
    docs = docs.drop("leaks")
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    blocks = 1 + items.count() // block
    kind = StructType.fromDDL(f"leaks array<struct<item_id:{items.schema['item_id'].dataType.simpleString()},distance:int,start_word:int,n_words:int>>")
    arrow = to_arrow_schema(kind).field("leaks").type
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    found = []
    for b in range(blocks):  # a block's expected size is `block` at most, whatever the benchmark's
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).distinct().orderBy("item_id", "text")
        rows = [(r.item_id, r.text) for r in part.collect()]
        if blocks == 1:
            return docs.mapInArrow(partial(_leaks, items=rows, kind=arrow, only=False), StructType([*docs.schema.fields, *kind.fields]))
        hits = keyed.mapInArrow(partial(_leaks, items=rows, kind=arrow, only=True), StructType([*keyed.schema.fields[:2], *kind.fields]))
        found.append(cut(hits.dropDuplicates(["doc_id", "text_hash"])))
    hits = reduce(DataFrame.unionByName, found).groupBy(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).agg(F.flatten(F.collect_list("leaks")).alias("leaks"))
    joined = docs.alias("d").join(hits.alias("h"), F.col("d.doc_id").eqNullSafe(F.col("h.hit_id")) & (F.xxhash64("d.text") == F.col("h.hit_hash")), "left")
    return joined.select("d.*", F.coalesce("h.leaks", F.array().cast(kind["leaks"].dataType)).alias("leaks"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item found in it; null and empty texts have none. Of equally good matches the first counts; of a repeated row each has its own."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, read(spark, sf_dir, "benchmark")).where(F.size("leaks") > 0)
    return found.select("doc_id", F.inline("leaks"))
