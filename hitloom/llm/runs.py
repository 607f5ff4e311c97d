"""Periodic runs of words, by Kruskal's order over the suffix classes of a text.

The suffixes of a text are sorted by doubling ranks, with each text's words and end its own, so texts are sorted together
and never match each other. Only suffixes that share words are ranked on. Neighbours in that order, by decreasing
length of their common prefix (LCP), unite classes of suffixes: union-find over ordered lists of positions, the smaller
list put into the larger. When a union makes two positions a < b neighbours in their class, at an LCP of l words, the
words from a to b + l have period b - a; if the words before a and b differ, that is a run's start. Every run whose LCP
is no less than its period is found once, with its smallest period.

Proof: let a run start at s with smallest period p and LCP l >= p of the suffixes s and s + p. A position k between them
in the class of l would give the run's head the period k - s also, and so, as the head has p + (k - s) words or more,
their greatest common divisor, which is less than p. Hence s and s + p become neighbours, at l. In the other
direction, if a and b = a + p become neighbours at l >= p and the words had a smaller period, it would divide p, and the
position one such period after a would stand between a and b since an earlier union.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

MIN_WORDS, MIN_TURNS = 6, 4
BLOCK_WORDS = 1 << 18
WORD = r"[^\x20\x09-\x0D]+"


def ranked(ids: np.ndarray, least: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks of the strings of 1, 2, 4, ... words at each place, and the suffixes that share `least` words or more with
    another, in the order of suffixes (some that share fewer may be among them).

    ids are dense, and each text ends with an id that occurs once, so a string over an end is unique. A rank is the place
    of the first of its equals among all suffixes, so sorting on never moves a suffix out of its class.
    """
    sizes = np.bincount(ids)
    rank = (np.cumsum(sizes) - sizes)[ids]
    ranks, h = [rank], 1
    active = np.flatnonzero(sizes[ids] > 1)
    sharing = active
    while len(active):
        old = rank[active]
        key = old * len(ids) + rank[active + h]
        order = np.argsort(key)
        active, old, key = active[order], old[order], key[order]
        at = np.arange(len(active))
        head = np.append(True, key[1:] != key[:-1])
        first = np.maximum.accumulate(np.where(head, at, 0))
        first_old = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), at, 0))
        rank = rank.copy()
        rank[active] = old + first - first_old
        active = active[~(head & np.append(head[1:], True))]
        h *= 2
        ranks.append(rank)
        if h <= least:
            sharing = active
    return ranks, sharing[np.argsort(rank[sharing])]


def neighbours(ranks: list[np.ndarray], suffixes: np.ndarray) -> np.ndarray:
    """The LCP of each suffix and the one after it."""
    x, y = suffixes[:-1], suffixes[1:]
    lcp = np.zeros(len(x), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        lcp += (ranks[k][x + lcp] == ranks[k][y + lcp]).astype(np.int64) << k
    return lcp


def united(suffixes: np.ndarray, lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(a, b, l) for every two positions that become neighbours in a class when classes are united at the LCP l, down to least."""
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    edges = np.flatnonzero(lcp >= least)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    for x, y, l in zip(suffixes[edges].tolist(), suffixes[edges + 1].tolist(), lcp[edges].tolist(), strict=True):
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        while (up := parent.get(y, y)) != y:
            parent[y] = y = parent.get(up, up)
        own, other = members.pop(x, None) or [x], members.pop(y, None) or [y]
        if len(own) < len(other):
            x, y, own, other = y, x, other, own
        parent[y] = x
        members[x] = own
        if 8 * len(other) < len(own):
            last = None  # the place before, if it came from the smaller list too
            for p, then in zip(other, [*other[1:], None], strict=True):
                at = bisect_left(own, p)
                if at and own[at - 1] != last:
                    yield own[at - 1], p, l
                if at < len(own) and (then is None or then > own[at]):
                    yield p, own[at], l
                own.insert(at, p)
                last = p
        else:
            small = set(other)
            own += other
            own.sort()
            for a, b in zip(own, own[1:]):
                if (a in small) != (b in small):
                    yield a, b, l


def runs_of(ids: np.ndarray, min_words: int = MIN_WORDS, min_turns: int = MIN_TURNS) -> list[tuple[int, int, int]]:
    """(start, length, period), in order, of the runs of at least min_words words and min_turns (2 or more) periods."""
    least = min(max(min_words - p, (min_turns - 1) * p) for p in range(1, min_words + 1))
    ranks, suffixes = ranked(ids, least)
    if len(suffixes) < 2:
        return []
    out = []
    for a, b, l in united(suffixes, neighbours(ranks, suffixes), least):
        p = b - a
        if l >= (min_turns - 1) * p and l + p >= min_words and (a == 0 or ids[a - 1] != ids[b - 1]):
            out.append((a, l + p, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    inside = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        inside[start + period] += 1
        inside[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(inside[:-1]) == 0)]


def block_runs(texts: list[list[bytes]], min_words: int, min_turns: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text (its words), all sorted together."""
    ids, base, starts = [], 0, [0]
    for words in texts:
        own: dict[bytes, int] = defaultdict(count(base).__next__)
        ids += map(own.__getitem__, words)
        base += len(own) + 1
        ids.append(base - 1)
        starts.append(len(ids))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = runs_of(np.array(ids, np.int64), min_words, min_turns)
    of = np.searchsorted(starts, [r[0] for r in found], side="right") - 1
    for k, (start, length, period) in zip(of.tolist(), found, strict=True):
        out[k].append((start - starts[k], length, period))
    return out


def _runs(batches: Iterator[pa.RecordBatch], min_words: int, min_turns: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> (doc_id, n_words, runs, collapsed)."""
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def rows(doc_ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = block_runs(texts, min_words, min_turns)
        columns = [
            pa.array(doc_ids, id_type), pa.array(map(len, texts), pa.int64()),
            pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in found], pa.list_(run)),
            pa.array([b" ".join(kept_words(words, own)).decode() for words, own in zip(texts, found, strict=True)], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    for batch in batches:
        id_type = batch.schema.field("doc_id").type
        doc_ids, texts, n = [], [], 0
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            doc_ids.append(doc_id)
            texts.append((text.as_py() or "").encode().split())  # bytes are split at just the six blanks of WORD
            n += len(texts[-1])
            if n >= BLOCK_WORDS:
                yield rows(doc_ids, texts)
                doc_ids, texts, n = [], [], 0
        if doc_ids:
            yield rows(doc_ids, texts)


def collapse_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_turns: int = MIN_TURNS) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed (the words left, by single blanks).

    A run is a stretch of words with smallest period q, of min_words words and min_turns periods or more, that can't be
    made longer; of each run its first q words stay, unless another run drops them. Null, empty and blank texts have no
    words, no runs and an empty collapsed text. Rows of the same or a null doc_id are texts of their own; extra columns are left out.
    Each text is looked at as a whole, in the task that reads it, together with others up to BLOCK_WORDS words.
    """
    if min_turns < 2 or min_words < 2:
        raise ValueError("a run has two words and two periods at least")
    docs = docs.select("doc_id", "text")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.mapInArrow(partial(_runs, min_words=min_words, min_turns=min_turns), schema)


def planted(docs: DataFrame) -> DataFrame:
    """docs, where a tenth of the texts, by crc32 of doc_id, goes on from a word as a repetition of the words there.

    With n words, h the crc32 and g = floor(h / 10): from the word a = g % n on, with the period 1 + floor((n - a) / (3 + g % 8)).
    Texts without words and rows of a null doc_id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    # the words are bound once, else the text would be split anew for each of them
    new = F.transform(F.array(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))), repeated)[0]
    return docs.withColumn("text", F.when((h % 10 == 0) & F.col("text").rlike(WORD), new).otherwise(F.col("text")))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document after planted(): their number, the longest, and digests of all runs and of the words left."""
    found = collapse_runs(planted(read(spark, sf_dir, "documents").select("doc_id", "text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = found.select("doc_id", "runs", "collapsed", longest.alias("longest"), listed.alias("listed"))
    length, period = F.col("longest.length"), -F.col("longest.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
