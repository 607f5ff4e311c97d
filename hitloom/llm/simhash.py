"""SimHash near-duplicates: fingerprints of word shingles, and a binary-trie self-join within a Hamming budget.

The join works on distinct fingerprints. Two of them within `budget` bits agree on at least `agree` of budget + agree
blocks of bits, so the trie is kept in one order of the bits for each choice of `agree` blocks, with these on top, and
each node below the top is a unit of work: from the pair (node, node) its pairs of children are followed, differing
bits are summed, and a pair is dropped once it has more than `budget`. A top node with more than HOT_NODE fingerprints
is split by the next SPLIT_BITS bits into pairs of its grandchildren, which become units of their own. A task links
what it finds by a forest (one edge for a node at most) instead of by all its pairs; components() joins the forests.

one_of_each() takes such components as candidates only, and decides by the exact similarity of word shingles.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial, reduce
from itertools import chain, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, read
from .components import components

SHINGLE, BUDGET = 3, 2
# of near copies: words in a shingle that is compared, and the least similarity (a share of NEAR[0] / NEAR[1])
NEAR_WORDS, NEAR = 5, (4, 5)
# of the search for them: words in a hashed shingle (fewer, as an edit changes fewer of them), fingerprints, bits
NEAR_SHINGLE, NEAR_PLANES, NEAR_BUDGET = 2, 2, 6
LEADERS, FOLLOWERS = 1024, 4096
HOT_NODE, SPLIT_BITS = 16384, 8
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BLOCK = 1 << 15  # shingles that are counted at once


def shingle_hashes(data: bytes | None, k: int) -> np.ndarray:
    """The XXH64 of each k-word shingle of a UTF-8 text, repeats included; of the whole sequence if it has fewer words."""
    words = (data or b"").translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - k + 1]
    pieces = map(joined.__getitem__, map(slice, starts.tolist(), (ends[k - 1 :] - 1).tolist()))
    return np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(42)), np.uint64, len(starts))


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have; 0 without hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at : at + BLOCK]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(data: bytes | None, k: int = SHINGLE) -> int:
    """The 64-bit SimHash of a UTF-8 text: majority of the XXH64 of its k-word shingles; 0 without words."""
    return majority(shingle_hashes(data, k))


def planes(data: bytes | None, k: int, n: int) -> list[int]:
    """n SimHashes of a text, independent of each other; the first is its fingerprint()."""
    h = shingle_hashes(data, k)
    out = [majority(h)]
    for _ in range(n - 1):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        out.append(majority(h))
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch], k: int, n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([planes(x.as_py(), k, n) for x in batch.column("data")], np.uint64).reshape(-1, n).view(np.int64)
        rest = [c for c in batch.schema.names if c != "data"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, rest), *(pa.array(found[:, i]) for i in range(n))], [*rest, "fp", *(f"fp{i}" for i in range(1, n))])


def fingerprints(docs: DataFrame, k: int = SHINGLE, n: int = 1) -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint as a signed long) of each document, and n - 1 more: fp1, fp2 ..."""
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("data"))
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long" + "".join(f", fp{i} long" for i in range(1, n))
    return docs.mapInArrow(partial(_fingerprints, k=k, n=n), kinds)


def _split(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """The first index in each [lo, hi) whose key has the bit; keys are sorted and alike above the bit within a range."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        one = ((keys[np.minimum(mid, len(keys) - 1)] >> np.uint64(bit)) & np.uint64(1)).astype(bool)
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)
    return lo


def trie_pairs(keys: np.ndarray, nodes: tuple[np.ndarray, ...], top: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of keys within budget, from node pairs (lo, hi, lo2, hi2, differing bits) whose keys agree above bit `top`.

    A node paired with itself has lo == lo2. Keys are sorted and distinct within each node.
    """
    lo, hi, lo2, hi2, err = nodes
    for bit in range(top, -1, -1):
        small = (hi - lo == 1) & (hi2 - lo2 == 1)  # two leaves: the rest of their bits is compared at once
        if small.any():
            a, b = lo[small], lo2[small]
            low = np.uint64((1 << (bit + 1)) - 1)
            near = err[small] + np.bitwise_count((keys[a] ^ keys[b]) & low) <= budget
            near &= a != b
            yield a[near], b[near]
            lo, hi, lo2, hi2, err = (x[~small] for x in (lo, hi, lo2, hi2, err))
        if not len(lo):
            return
        mid, mid2 = _split(keys, lo, hi, bit), _split(keys, lo2, hi2, bit)
        own = lo == lo2
        parts = [(lo, mid, lo2, mid2, err, slice(None)), (mid, hi, mid2, hi2, err, slice(None)), (lo, mid, mid2, hi2, err + 1, slice(None)), (mid, hi, lo2, mid2, err + 1, ~own)]
        lo, hi, lo2, hi2, err = (np.concatenate([p[i][p[5]] for p in parts]) for i in range(5))
        live = (lo < hi) & (lo2 < hi2) & (err <= budget) & ~((lo == lo2) & (hi - lo == 1))
        lo, hi, lo2, hi2, err = (x[live] for x in (lo, hi, lo2, hi2, err))
    if len(lo):  # all bits are used up: both are leaves
        yield lo, lo2


def forest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The least node of each of n nodes' component, under the links a-b."""
    label = np.arange(n) if label is None else label
    while True:
        x, y = label[a], label[b]
        high, low = np.maximum(x, y), np.minimum(x, y)
        if (high == low).all():
            return label
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]


def _forest_of(unit: np.ndarray, side: np.ndarray, keys: np.ndarray, fps: np.ndarray, width: list[int], budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of whole units (order, block, ca, cb) -> forest edges between fingerprints."""
    order = np.lexsort((keys, side, unit[3], unit[2], unit[1], unit[0]))
    unit, side, keys, fps = unit[:, order], side[order], keys[order], fps[order]
    new = np.ones(len(keys), bool)
    new[1:] = (unit[:, 1:] != unit[:, :-1]).any(axis=0)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(keys))
    middle = starts + np.add.reduceat(side == 0, starts)
    nodes, label = np.unique(fps, return_inverse=True)
    root = np.arange(len(nodes))
    split, rot = unit[2, starts] >= 0, unit[0, starts]
    for r in np.unique(rot):
        for is_split in (False, True):
            pick = (rot == r) & (split == is_split)
            if not pick.any():
                continue
            top = 64 - width[r] - 1 - (SPLIT_BITS if is_split else 0)
            lo, hi = starts[pick], ends[pick]
            if is_split:
                ca, cb = unit[2, lo], unit[3, lo]
                cross = ca != cb
                lo2, mid = np.where(cross, middle[pick], lo), np.where(cross, middle[pick], hi)
                err = np.bitwise_count((ca ^ cb).astype(np.uint64)).astype(np.int64)
                pairs = (lo, mid, lo2, hi, err)
            else:
                pairs = (lo, hi, lo.copy(), hi.copy(), np.zeros(len(lo), np.int64))
            live = (pairs[0] < pairs[1]) & (pairs[2] < pairs[3]) & ~((pairs[0] == pairs[2]) & (pairs[1] - pairs[0] == 1))
            for a, b in trie_pairs(keys, tuple(x[live] for x in pairs), top, budget):
                root = forest(len(nodes), label[a], label[b], root)
    tied = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[tied], nodes[root[tied]]


def _links(batches: Iterator[pa.RecordBatch], budget: int, width: list[int]) -> Iterator[pa.RecordBatch]:
    """Rows (plane, rot, block, ca, cb, side, key, fp) of whole units -> forest edges (plane, a, b) between fingerprints."""
    batches = [x for x in batches if x.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches)  # 37 bytes for each fingerprint of one shuffle partition
    col = lambda c: table.column(c).to_numpy()
    unit = np.stack([col("rot").astype(np.int64), col("block"), col("ca").astype(np.int64), col("cb").astype(np.int64)])
    plane, side, keys, fps = col("plane"), col("side"), col("key").view(np.uint64), col("fp")
    for p in np.unique(plane):
        own = plane == p
        a, b = _forest_of(unit[:, own], side[own], keys[own], fps[own], width, budget)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), p, np.int32)), pa.array(a), pa.array(b)], ["plane", "a", "b"])


def bit_orders(budget: int, agree: int) -> list[tuple[list[tuple[int, int]], int]]:
    """For each choice of `agree` of budget + agree blocks: the runs (first bit, bits) of the key, and the bits on top."""
    n = budget + agree
    blocks = [(64 * i // n, 64 * (i + 1) // n - 64 * i // n) for i in range(n)]
    out = []
    for top in combinations(range(n), agree):
        runs: list[tuple[int, int]] = []
        for at, bits in [blocks[i] for i in top] + [blocks[(top[0] + j) % n] for j in range(n) if (top[0] + j) % n not in top]:
            if runs and sum(runs[-1]) == at:
                at, bits = runs[-1][0], runs.pop()[1] + bits
            runs.append((at, bits))
        out.append((runs, sum(blocks[i][1] for i in top)))
    return out


def reordered(fps: np.ndarray, runs: list[tuple[int, int]]) -> np.ndarray:
    """Unsigned fps with their bits (counted from the greatest) in the order of the runs."""
    out, at = np.zeros_like(fps), 0
    for first, bits in runs:
        out |= ((fps << np.uint64(first)) >> np.uint64(64 - bits)) << np.uint64(64 - at - bits)
        at += bits
    return out


def _units(batches: Iterator[pa.RecordBatch], orders: list[tuple[list[tuple[int, int]], int]], count: bool) -> Iterator[pa.RecordBatch]:
    """(plane, fp) -> (plane, rot, block, key, child, fp) for each order of the bits; count: how many a (plane, rot, block) has."""
    for batch in batches:
        plane, fp = batch.column("plane").to_numpy(), batch.column("fp").to_numpy()
        for at in range(0, len(fp), BLOCK):
            own, planes_ = fp[at : at + BLOCK], plane[at : at + BLOCK]
            for r, (runs, top) in enumerate(orders):
                key = reordered(own.view(np.uint64), runs)
                block = (key >> np.uint64(64 - top)).view(np.int64)
                if count:
                    found, n = np.unique(np.stack([planes_.astype(np.int64), block]), axis=1, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(found[0].astype(np.int32)), pa.array(np.full(len(n), r, np.int32)), pa.array(found[1]), pa.array(n)], ["plane", "rot", "block", "n"])
                else:
                    child = ((key << np.uint64(top)) >> np.uint64(64 - SPLIT_BITS)).astype(np.int32)
                    columns = [planes_, np.full(len(own), r, np.int32), block, key.view(np.int64), child, own]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["plane", "rot", "block", "key", "child", "fp"])


def trie_links(distinct: DataFrame, budget: int = BUDGET, hot_node: int = HOT_NODE, agree: int = 1) -> DataFrame:
    """distinct (plane, fp) -> links (plane, a, b) that join the same components of a plane as all pairs within `budget` bits do.

    agree changes the work, not the result: more blocks on top make more orders of smaller nodes.
    """
    orders = bit_orders(budget, agree)
    width = [top for _, top in orders]
    distinct = distinct.select(F.col("plane").cast("int").alias("plane"), "fp")
    sizes = distinct.mapInArrow(partial(_units, orders=orders, count=True), "plane int, rot int, block long, n long")
    hot = cut(sizes.groupBy("plane", "rot", "block").agg(F.sum("n").alias("n")).where(F.col("n") > hot_node).select("plane", "rot", "block"))
    rows = distinct.mapInArrow(partial(_units, orders=orders, count=False), "plane int, rot int, block long, key long, child int, fp long")
    if hot.isEmpty():
        rows = rows.select("plane", "rot", "block", F.lit(-1).alias("ca"), F.lit(-1).alias("cb"), F.lit(0).alias("side"), "key", "fp")
    else:
        rows = rows.join(hot.withColumn("hot", F.lit(True)), ["plane", "rot", "block"], "left")
        near = [m for m in range(1 << SPLIT_BITS) if m.bit_count() <= budget]
        other = F.when(F.col("hot"), F.transform(F.lit(near), lambda m: F.col("child").bitwiseXOR(m))).otherwise(F.array(F.lit(-1)))
        rows = rows.withColumn("other", F.explode(other)).select(
            "plane", "rot", "block",
            F.when(F.col("hot"), F.least("child", "other")).otherwise(-1).alias("ca"),
            F.when(F.col("hot"), F.greatest("child", "other")).otherwise(-1).alias("cb"),
            F.when(F.col("hot") & (F.col("child") > F.col("other")), 1).otherwise(0).alias("side"),
            "key", "fp",
        )
    return rows.repartition("plane", "rot", "block", "ca", "cb").mapInArrow(partial(_links, budget=budget, width=width), "plane int, a long, b long")


def grouped(docs: DataFrame, k: int = SHINGLE, budget: int = BUDGET, hot_node: int = HOT_NODE) -> DataFrame:
    """doc_id, text_hash, fp, root (the least fingerprint of the group) and component_id (its least doc_id) of each row.

    Texts without words, null ones included, have fingerprint zero and are linked like any other. Repeated rows stay.
    A null doc_id never names a component, unless the component has no other. An empty table gives no rows.
    """
    prints = cut(fingerprints(docs, k))
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = cut(components(trie_links(classes.select(F.lit(0).alias("plane"), "fp"), budget, hot_node))).withColumnRenamed("node", "fp")
    least = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = least.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(least.join(named, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, budget: int = BUDGET, hot_node: int = HOT_NODE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the least doc_id reachable) of each document, as grouped()."""
    return grouped(docs, k, budget, hot_node).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


class Leaders:
    """Sets of shingles that were kept, with the sets that hold each shingle."""

    def __init__(self):
        self.sizes: list[int] = []
        self.holders: dict[int, list[int]] = {}

    def add(self, shingles: list[int]) -> None:
        for s in shingles:
            self.holders.setdefault(s, []).append(len(self.sizes))
        self.sizes.append(len(shingles))

    def like(self, shingles: list[int]) -> bool:
        """Whether any of the sets has a Jaccard similarity of NEAR or more; empty sets are alike."""
        if not shingles:
            return 0 in self.sizes
        found = list(chain.from_iterable(filter(None, map(self.holders.get, shingles))))
        if not found:
            return False
        common = np.bincount(found)
        total = np.array(self.sizes[: len(common)]) + len(shingles) - common
        return bool((NEAR[1] * common >= NEAR[0] * total).any())


def shingles_of(data: bytes | None) -> list[int]:
    return np.unique(shingle_hashes(data, NEAR_WORDS)).tolist()


def _lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (root, ..., data) of whole components, in their order -> those unlike all rows kept before in the component."""
    root, leaders = None, Leaders()
    for batch in batches:
        keep = []
        for own, data in zip(batch.column("root").to_pylist(), batch.column("data"), strict=True):
            if own != root:
                root, leaders = own, Leaders()
            shingles = shingles_of(data.as_py())
            keep.append(not leaders.like(shingles))
            if keep[-1]:
                leaders.add(shingles)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (root, salt, leads, ..., data), leading rows of each (root, salt) first -> the others that are unlike these."""
    part, leaders = None, Leaders()
    for batch in batches:
        keep = []
        for root, salt, leads, data in zip(*(batch.column(c).to_pylist() for c in ("root", "salt", "leads")), batch.column("data"), strict=True):
            if (root, salt) != part:
                part, leaders = (root, salt), Leaders()
            shingles = shingles_of(data.as_py())
            keep.append(not leads and not leaders.like(shingles))
            if leads:
                leaders.add(shingles)
        yield batch.filter(pa.array(keep, pa.bool_()))


def near_components(prints: DataFrame, budget: int, hot_node: int, agree: int) -> DataFrame:
    """prints (text_key, fp, fp1 ...), one row for each text -> (text_key, root) of texts that share or link a fingerprint."""
    names = [c for c in prints.columns if c.startswith("fp")]
    nodes = prints.withColumn("node", F.xxhash64("text_key"))  # nodes that fall together are candidates more, no more than that
    own = nodes.select("node", F.posexplode(F.array(*names)).alias("plane", "fp"))
    first = cut(own.groupBy("plane", "fp").agg(F.min("node").alias("m"), F.max("node").alias("last")))
    found = trie_links(first.select("plane", "fp"), budget, hot_node, agree)
    of = lambda side: first.select("plane", F.col("fp").alias(side), F.col("m").alias("node_" + side))
    links = found.join(of("a"), ["plane", "a"]).join(of("b"), ["plane", "b"]).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    shared = own.join(first.where("m != last").select("plane", "fp", "m"), ["plane", "fp"]).where("node != m").select(F.col("node").alias("a"), F.col("m").alias("b"))
    roots = components(links.unionByName(shared))
    return nodes.join(roots, "node").select("text_key", "root")


def unlike(members: DataFrame, leaders: int = LEADERS) -> DataFrame:
    """members (root, none, doc_id, text_key, data) -> those that stay: in the order of none, doc_id and text_key, a text
    stays unless it is like (NEAR) one of its component that stays.

    A round settles the first `leaders` open texts of each component, and compares all its other ones with those of
    them that stay, dealt out by a salt; a component of n texts that are all unlike takes n / leaders rounds.
    """
    order = ["none", "doc_id", "text_key"]
    kind, salts = members.schema, F.ceil(F.col("size") / FOLLOWERS).cast("int")
    open_, kept = members, []
    while True:
        rank = F.row_number().over(Window.partitionBy("root").orderBy(*order))
        first = open_.select("root", *order).withColumn("n", rank).where(F.col("n") <= leaders).select("root", "text_key")  # ranked without their texts
        top = cut(open_.join(first, ["root", "text_key"], "left_semi").select(members.columns))
        lead = cut(top.repartition("root").sortWithinPartitions("root", *order).mapInArrow(_lead, kind))
        kept.append(lead)
        rest = open_.join(top.select("root", "text_key"), ["root", "text_key"], "left_anti").select(members.columns)
        rest = cut(rest)
        sizes = rest.groupBy("root").agg(F.count("*").alias("size"))
        if sizes.isEmpty():
            return reduce(DataFrame.unionByName, kept)
        sizes = cut(sizes)
        copies = lead.join(sizes, "root").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).withColumn("leads", F.lit(True)).drop("size")
        others = rest.join(sizes, "root").withColumn("salt", F.pmod(F.hash("text_key"), salts)).withColumn("leads", F.lit(False)).drop("size")
        dealt = copies.unionByName(others).repartition("root", "salt").sortWithinPartitions("root", "salt", F.desc("leads"))
        open_ = cut(dealt.mapInArrow(_follow, dealt.schema).select(members.columns))


def one_of_each(docs: DataFrame, k: int = NEAR_SHINGLE, budget: int = NEAR_BUDGET, n: int = NEAR_PLANES, hot_node: int = HOT_NODE, agree: int = 2) -> DataFrame:
    """The rows of docs that stay: of equal texts the one with the least doc_id (nulls last), and of texts that one of n
    fingerprints links within `budget` bits, directly or by others, those that are unlike all lesser ones that stay.

    Texts are alike from a Jaccard similarity of NEAR of their distinct NEAR_WORDS-word shingles. Texts without words,
    null ones included, are alike. Rows equal in doc_id and text are one; all columns stay.
    """
    key = lambda text: F.unhex(F.substring(F.sha2(F.coalesce(text.cast("binary"), F.lit(b"")), 256), 1, 32))
    keyed = docs.select("doc_id", key(F.col("text")).alias("text_key"), F.col("text").cast("binary").alias("data"))
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key binary, " + ", ".join(["fp long", *(f"fp{i} long" for i in range(1, n))])
    prints = cut(keyed.mapInArrow(partial(_fingerprints, k=k, n=n), kinds))
    names = [c for c in prints.columns if c.startswith("fp")]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("first")
    texts = cut(prints.groupBy("text_key").agg(first, *(F.min(c).alias(c) for c in names)))  # equal texts have equal ones
    near = cut(near_components(texts.select("text_key", *names), budget, hot_node, agree).join(texts.select("text_key", "first.none", "first.doc_id"), "text_key"))
    same = F.col("k.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("k.text_key") == F.col("n.text_key"))
    members = cut(keyed.alias("k").join(near.alias("n"), same).select("n.root", "n.none", "n.doc_id", "n.text_key", "k.data").dropDuplicates(["text_key"]))
    lost = near.select("text_key").join(unlike(members).select("text_key"), "text_key", "left_anti")
    stay = texts.join(lost, "text_key", "left_anti").select("first.doc_id", "text_key")
    kept = docs.alias("d").join(stay.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (key(F.col("d.text")) == F.col("s.text_key")), "left_semi")
    again = prints.groupBy("doc_id", "text_key").count().where("count > 1").limit(1).count()
    if not again:
        return kept
    name = f"key_{uuid.uuid4().hex}"  # no column of docs has it
    return kept.withColumn(name, key(F.col("text"))).dropDuplicates(["doc_id", name]).drop(name)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component; texts without words (null ones included) have fingerprint zero. Equal doc_ids tie: each row keeps its own fingerprint."""
    return near_duplicates(read(spark, sf_dir, "documents"))
