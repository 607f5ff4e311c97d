"""Removal of repeated byte strings (400 bytes) across all documents, decided by suffix arrays.

Every window of SPAN bytes is filed under its anchor, the leftmost of the least-hashed Q-grams in it; equal windows have
equal anchors at equal places. A document gives a row for each anchor: the anchor's hash, a hash of the piece of text
that the anchor's windows cover, and the place. Rows of one anchor and one piece are counted before they are shuffled:
a piece that occurs twice is repeated as a whole. Only anchors with several different pieces need the texts, one of each
piece. Such pieces are cut once more, into STEP windows by their distance from the anchor: all windows of a cut share a
core, and only cuts of equal cores can hold equal windows. Where the texts around a core differ, the suffixes of these
texts are sorted, the core standing as one symbol, and windows next to each other in suffix order are compared.

The suffix order is built by grouping: suffixes start in groups by symbol; groups are taken in descending order, and each
member is counted at the nearest suffix before it that isn't taken yet, which then moves up to a group of its own, its
Lyndon prefix extended by the taken group's. Once all are taken, the groups are in order, and one ascending pass puts
the members of each in order, following the same pointers: no recursion, no renaming.

A core with more than HOT_PIECES different surroundings would be too much for one task, so its cuts are cut again into
fewer windows, whose cores are longer and therefore shared by fewer; at last a cut is one window, which is its own core.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read, with_fields

SPAN, Q, STEP = 400, 128, 32
NARROWER = 4  # times fewer windows in a cut of a core that too many share
HOT_PIECES, BATCH, SALTS = 1500, 1 << 17, 16
BLOCK = 1 << 20
_RNG = np.random.default_rng(2024)
BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
IDX = np.uint64((1 << 21) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


class Anchors:
    """Rolling hashes and window minima of one span and gram length."""

    def __init__(self, span: int, q: int):
        self.span, self.q, self.w = span, q, span - q + 1
        n = BLOCK + span + 1
        self.up, self.down = _powers(BASE, n), _powers(pow(BASE, -1, 1 << 64), n)

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, anchor place, first window, windows) of each run of windows with one anchor."""
        parts = []
        for at in range(0, len(data) - self.span + 1, BLOCK):
            x = np.frombuffer(data[at : at + BLOCK + self.span - 1], np.uint8)
            c = np.zeros(len(x) + 1, np.uint64)
            np.cumsum(BYTE[x] * self.up[: len(x)], out=c[1:])
            h = (c[self.q :] - c[: -self.q]) * self.down[: len(x) - self.q + 1]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
            key = (h & ~IDX) | np.arange(len(h), dtype=np.uint64)
            w, n = self.w, len(h)
            padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
            padded[:n] = key
            rows = padded.reshape(-1, w)
            left = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
            right = np.minimum.accumulate(rows, axis=1).ravel()
            place = (np.minimum(left[: n - w + 1], right[w - 1 : n]) & IDX).astype(np.int64)
            first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
            size = np.diff(np.append(first, len(place)))
            parts.append((h[place[first]].view(np.int64), place[first] + at, first + at, size))
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True)) if parts else tuple(np.zeros(0, np.int64) for _ in range(4))


def merge(ranges: np.ndarray) -> np.ndarray:
    """Sorted, disjoint [lo, hi) ranges that cover the same integers as the given ones; touching ranges are one."""
    if not len(ranges):
        return ranges.reshape(0, 2)
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    top = np.maximum.accumulate(ranges[:, 1])
    new = np.append(True, ranges[1:, 0] > top[:-1])
    at = np.flatnonzero(new)
    return np.stack([ranges[at, 0], top[np.append(at[1:], len(ranges)) - 1]], axis=1)


def _anchor_rows(batches: Iterator[pa.RecordBatch], span: int, q: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, dh, data) -> anchors (h, ph, a, w, off, n), n: how often the document has the piece; ranges of windows
    that repeat within the document have h null."""
    find = Anchors(span, q)
    names = ["doc_id", "dh", "h", "ph", "a", "w", "off", "n"]
    for batch in batches:
        rows, own = [], []
        for k, data in enumerate(batch.column("data")):
            data = data.as_py() or b""
            if len(data) < span:
                continue
            h, place, a, w = find.of(data)
            ph = np.fromiter((xxhash.xxh3_64_intdigest(data[i:j]) for i, j in zip(a.tolist(), (a + w + span - 1).tolist(), strict=True)), np.uint64, len(a)).view(np.int64)
            _, first, inverse, n = np.unique(np.stack([h, ph], axis=1), axis=0, return_index=True, return_inverse=True, return_counts=True)
            again = n[inverse.ravel()] > 1
            rows.append((np.full(len(first), k), h[first], ph[first], a[first], w[first], (place - a)[first], n))
            own += [(k, lo, hi - lo) for lo, hi in merge(np.stack([a, a + w], axis=1)[again]).tolist()]
        if not rows:
            continue
        k, h, ph, a, w, off, n = (np.concatenate(c) for c in zip(*rows, strict=True))
        o = np.array(own, np.int64).reshape(-1, 3)
        of = lambda c: batch.column(c).take(pa.array(np.concatenate([k, o[:, 0]])))
        zero = np.zeros(len(o), np.int64)
        col = lambda x, y, t: pa.array(np.concatenate([x, y]), t)
        hs = pa.array(np.concatenate([h, zero]), pa.int64(), mask=np.append(np.zeros(len(h), bool), np.ones(len(o), bool)))
        yield pa.RecordBatch.from_arrays([of("doc_id"), of("dh"), hs, col(ph, zero, pa.int64()), col(a, o[:, 1], pa.int32()), col(w, o[:, 2], pa.int32()), col(off, zero, pa.int32()), col(n, zero, pa.int32())], names)


def suffix_array(s: list[int]) -> list[int]:
    """The suffix order of s; a suffix that is the beginning of another comes before it."""
    n = len(s)
    s = [*s, min(s, default=0) - 1]  # a least, single last symbol
    members: list[list[int]] = []
    of_symbol = {c: g for g, c in enumerate(sorted(set(s)))}
    members = [[] for _ in of_symbol]
    group = [of_symbol[c] for c in s]
    for i, g in enumerate(group):
        members[g].append(i)
    higher = list(range(1, len(members))) + [-1]
    lower = list(range(-1, len(members) - 1))
    length = [1] * len(members)
    free = list(range(n + 2))  # free[i + 1]: towards the nearest suffix at or before i that isn't taken; 0: none
    prev = [-1] * (n + 1)
    g = len(members) - 1
    while g >= 0:
        here = [i for i in members[g] if group[i] == g]
        members[g] = here
        for i in here:
            free[i + 1] = i
        counts: dict[int, int] = {}
        for i in here:
            p = i
            while free[p] != p:
                free[p] = p = free[free[p]]
            free[i + 1] = p
            p -= 1
            prev[i] = p
            if p >= 0:
                counts[p] = counts.get(p, 0) + 1
        if counts:
            size = length[g]
            most = max(counts.values())
            for times in range(most, 0, -1) if most > 1 else (1,):
                to: dict[int, int] = {}
                for p, c in counts.items():
                    if c == times:
                        old = group[p]
                        new = to.get(old)
                        if new is None:
                            to[old] = new = len(members)
                            members.append([])
                            length.append(length[old] + times * size)
                            up = higher[old]
                            lower.append(old)
                            higher.append(up)
                            higher[old] = new
                            if up >= 0:
                                lower[up] = new
                        group[p] = new
                        members[new].append(p)
        g = lower[g]
    slot = [0] * len(members)
    g, at = 0, 0
    while lower[g] >= 0:
        g = lower[g]
    while g >= 0:
        slot[g] = at
        at += len(members[g])
        g = higher[g]
    order = [n] * (n + 1)
    for k in range(n + 1):
        start = order[k]
        i = start - 1
        while i >= 0 and i + length[group[i]] == start:
            g = group[i]
            order[slot[g]] = i
            slot[g] += 1
            i = prev[i]
    return order[1:]


def repeated_windows(pieces: list[tuple[int, bytes, bytes, int]], width: int) -> list[np.ndarray]:
    """pieces (core, text before it, text after it, windows) -> for each, the ranges of windows that another place has.

    A core stands as one symbol, and a window is `width` symbols. Each piece ends in a symbol of its own.
    """
    symbols, starts = [], []
    name = {h: 256 + k for k, h in enumerate(dict.fromkeys(p[0] for p in pieces))}
    last = 256 + len(name)
    usable = []
    for h, left, right, w in pieces:
        starts.append(len(symbols))
        usable.append(np.arange(w) + len(symbols))
        symbols += left
        symbols.append(name[h])
        symbols += right
        symbols.append(last)
        last += 1
    order = np.array(suffix_array(symbols), np.int64)
    ok = np.zeros(len(symbols), bool)
    ok[np.concatenate(usable)] = True
    raw = np.array(symbols, np.uint32).tobytes()
    fine = ok[order]
    hit = np.zeros(len(symbols), bool)
    for k in np.flatnonzero(fine[1:] & fine[:-1]).tolist():
        i, j = int(order[k]), int(order[k + 1])
        if raw[4 * i : 4 * (i + width)] == raw[4 * j : 4 * (j + width)]:
            hit[i] = hit[j] = True
    out = []
    for at, (_, _, _, w) in zip(starts, pieces, strict=True):
        found = np.flatnonzero(hit[at : at + w])
        out.append(merge(np.stack([found, found + 1], axis=1)))
    return out


def signed(data: bytes) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(data), "little", signed=True)


def _cuts(batches: Iterator[pa.RecordBatch], span: int, step: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, dh, data, wanted) -> the wanted pieces' cuts: hashes of core (h) and surroundings (ph), and the surroundings."""
    names = ["doc_id", "dh", "a", "w", "cnt", "h", "ph", "lead", "tail"]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for doc_id, dh, data, wanted in zip(*(batch.column(c) for c in ("doc_id", "dh", "data", "wanted")), strict=True):
            doc_id, dh, data = doc_id.as_py(), dh.as_py(), data.as_py()
            for x in wanted.as_py():
                at, most, least = x["a"] + x["off"], x["off"], x["off"] - x["w"] + 1
                for k in range(least // step, most // step + 1):
                    first, last = at - min(most, k * step + step - 1), at - max(least, k * step)
                    lo, hi = at - k * step, at - k * step - step + 1 + span
                    lead, tail = data[first:lo], data[hi : last + span]
                    h = signed(b"%d %d " % (x["h"], k) + data[lo:hi])
                    for column, value in zip(out, (doc_id, dh, first, last - first + 1, x["cnt"], h, signed(b"%d " % len(lead) + lead + tail), lead, tail), strict=True):
                        column.append(value)
        types = [batch.schema.field("doc_id").type, pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)


def _sorted(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[pa.RecordBatch]:
    """Cuts in order of h -> ranges of repeated windows (doc_id, dh, a, w) of the cuts that occur once."""
    kind = None

    def solve(rows):
        out: list[list] = [[], [], [], []]
        for r, found in zip(rows, repeated_windows([(r[3], r[5], r[6], r[4]) for r in rows], step), strict=True):
            if r[7] == 1:
                for lo, hi in found.tolist():
                    for column, value in zip(out, (r[0], r[1], r[2] + lo, hi - lo), strict=True):
                        column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(out[0], kind), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32())], ["doc_id", "dh", "a", "w"])

    def rows_of():
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            yield from zip(*(batch.column(c).to_pylist() for c in ("doc_id", "dh", "a", "h", "w", "lead", "tail", "cnt")), strict=True)

    rows, size = [], 0
    for _, own in groupby(rows_of(), key=lambda r: r[3]):
        own = list(own)
        rows += own
        size += sum(len(r[5]) + len(r[6]) + 2 for r in own)
        if size >= BATCH:
            yield solve(rows)
            rows, size = [], 0
    if rows:
        yield solve(rows)


def _narrowed(batches: Iterator[pa.RecordBatch], step: int, narrow: int) -> Iterator[pa.RecordBatch]:
    """Cuts of up to `step` windows -> cuts of up to `narrow`; the bytes that all windows of such a cut share join its core."""
    names = ["doc_id", "dh", "a", "w", "cnt", "h", "ph", "lead", "tail"]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for doc_id, dh, a, w, cnt, h, lead, tail in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "dh", "a", "w", "cnt", "h", "lead", "tail")), strict=True):
            n = len(lead)  # windows begin 0 to n bytes before the core
            for j in range((n - w + 1) // narrow, n // narrow + 1):
                most, least = min(n, (j + 1) * narrow - 1), max(n - w + 1, j * narrow)
                left, right = n - j * narrow, step - (j + 1) * narrow
                core = signed(b"%d %d " % (h, j) + lead[left:] + tail[:right])
                own = lead[n - most : left], tail[right : step - 1 - least]
                for column, value in zip(out, (doc_id, dh, a + n - most, most - least + 1, cnt, core, signed(b"%d " % len(own[0]) + own[0] + own[1]), *own), strict=True):
                    column.append(value)
        types = [batch.schema.field("doc_id").type, pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)


def spread(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """rows (h, ph, ...) joined to keys (h, ...), one row for each h; the pieces of a frequent h are dealt to SALTS tasks."""
    salted = keys.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return rows.withColumn("salt", F.pmod("ph", F.lit(SALTS))).join(salted, ["h", "salt"]).drop("salt")


def repeated_ranges(docs: DataFrame, span: int = SPAN, q: int = Q, step: int = STEP, hot_pieces: int = HOT_PIECES) -> DataFrame:
    """docs (doc_id, dh, data) -> (doc_id, dh, a, w): runs of w window starts from a whose strings start elsewhere too."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    ranges = ["doc_id", "dh", "a", "w"]
    rows = cut(docs.mapInArrow(partial(_anchor_rows, span=span, q=q), f"doc_id {id_type}, dh long, h long, ph long, a int, w int, off int, n int"))
    own = rows.where("h is null").select(ranges)
    rows = rows.where("h is not null")
    several = rows.groupBy("h").agg(F.sum("n").alias("c")).where("c > 1").select("h")
    rows = cut(rows.join(several, "h"))
    pieces = cut(rows.groupBy("h", "ph").agg(F.sum("n").alias("cnt"), F.min(F.struct("doc_id", "dh", "a", "w", "off")).alias("one")))
    whole = rows.join(pieces.where("cnt > 1").select("h", "ph"), ["h", "ph"]).select(ranges)

    kinds = pieces.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1").select("h")
    wanted = spread(pieces, kinds).select("one.doc_id", "one.dh", F.struct("one.a", "one.w", "one.off", "h", "cnt").alias("x"))
    wanted = wanted.groupBy("doc_id", "dh").agg(F.collect_list("x").alias("wanted")).withColumnsRenamed({"doc_id": "d", "dh": "k"})
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("dh") == F.col("k"))).dropDuplicates(["doc_id", "dh"]).select("doc_id", "dh", "data", "wanted")
    cuts = cut(texts.mapInArrow(partial(_cuts, span=span, step=step), f"doc_id {id_type}, dh long, a int, w int, cnt long, h long, ph long, lead binary, tail binary"))

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = [own, whole]
    while True:
        around = cut(cuts.groupBy("h", "ph").agg(F.sum("cnt").alias("all"), F.min(F.struct("doc_id", "dh", "a", "w", "lead", "tail")).alias("one")))
        found.append(cuts.where("cnt = 1").join(around.where("all > 1").select("h", "ph"), ["h", "ph"]).select(ranges))
        kinds = around.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1")
        open_ = cut(spread(around, kinds).select("h", "kinds", F.col("all").alias("cnt"), "one.*"))
        few = open_.where(F.col("kinds") <= hot_pieces).repartition(parts, "h").sortWithinPartitions("h")
        found.append(few.mapInArrow(partial(_sorted, step=step), f"doc_id {id_type}, dh long, a int, w int"))
        hot = open_.where(F.col("kinds") > hot_pieces)
        if hot.isEmpty():
            return reduce(DataFrame.unionByName, found)
        narrow = max(1, step // NARROWER)
        cuts, step = cut(hot.mapInArrow(partial(_narrowed, step=step, narrow=narrow), cuts.schema)), narrow


def _strip(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """(..., data, ranges) -> the removed byte spans and the bytes that are left."""
    for batch in batches:
        spans, kept = [], []
        for data, ranges in zip(batch.column("data"), batch.column("ranges"), strict=True):
            data, ranges = data.as_py() or b"", ranges.as_py()
            found = merge(np.array([(r["a"], r["a"] + r["w"] + span - 1) for r in ranges or ()], np.int64).reshape(-1, 2))
            spans.append([{"start": lo, "end": hi} for lo, hi in found.tolist()])
            edges = [0, *found.ravel().tolist(), len(data)]
            kept.append(b"".join(data[lo:hi] for lo, hi in zip(edges[::2], edges[1::2], strict=True)))
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        rest = [c for c in batch.schema.names if c not in ("data", "ranges")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array([len(x.as_py() or b"") for x in batch.column("data")], pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], [*rest, "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, span: int = SPAN, q: int = Q, step: int = STEP, hot_pieces: int = HOT_PIECES) -> DataFrame:
    """doc_id, n_bytes, spans (start and end of the removed runs) and kept (the bytes left) of each document.

    Bytes are removed wherever a string of `span` bytes covers them that also starts elsewhere, in this document or
    another; kept need not be valid UTF-8. A null text counts as empty. Rows equal in doc_id and text are documents of
    their own, and so repeat each other. Extra columns are left out; an empty table gives no rows.
    """
    docs = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("dh"), F.col("text").cast("binary").alias("data"))
    found = repeated_ranges(docs, span, q, step, hot_pieces).groupBy("doc_id", "dh").agg(F.collect_list(F.struct("a", "w")).alias("ranges")).withColumnsRenamed({"doc_id": "d", "dh": "k"})
    joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("dh") == F.col("k")), "left").select("doc_id", "data", "ranges")
    return joined.mapInArrow(partial(_strip, span=span), with_fields(joined.select("doc_id"), "n_bytes long, spans array<struct<start:int,end:int>>, kept binary"))


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's removed bytes; a null or empty text has 0 bytes, equal rows repeat each other."""
    out = remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
