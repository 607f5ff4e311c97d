"""Sharding by longest-processing-time scheduling: groups that must stay together, largest first, to the least-loaded shard.

Documents of equal text form a group. Groups of equal size can stand in for each other, so the heap needs only how many
groups there are of each size: it places a whole size class at once, exactly as it would place its groups one by one,
and says how many of them each shard takes. The groups of a class are numbered on the executors and take their shards
by number. No group passes through the driver: what it gets is one row for each distinct group size, and as k distinct
sizes are at least k * (k + 1) / 2 bytes, there are at most sqrt(2 * bytes) of them (250 thousand for 30 GB).
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, read

ONE_BY_ONE = 256
SLOT_CELLS = 2048


def fill(load: list[int], size: int, count: int) -> list[int]:
    """How many of `count` items of one size each shard gets if each goes to the least-loaded one (ties to the lowest)."""
    got = [0] * len(load)
    if count <= ONE_BY_ONE:
        heap = [(x, s) for s, x in enumerate(load)]
        heapq.heapify(heap)
        for _ in range(count):
            x, s = heap[0]
            got[s] += 1
            heapq.heapreplace(heap, (x + size, s))
        return got
    below = lambda level: [max(0, -((x - level) // size)) for x in load]  # noqa: E731  placements at loads under the level
    lo, hi = min(load), max(load) + size * count
    while lo < hi:  # the highest level that takes no more than `count` items
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if sum(below(mid)) <= count else (lo, mid - 1)
    got = below(lo)
    at_level = [s for s, x in enumerate(load) if x + got[s] * size == lo]
    for s in at_level[: count - sum(got)]:
        got[s] += 1
    return got


def lpt(classes: list[tuple[int, int]], shards: int) -> list[list[int]]:
    """(size, how many groups), by size descending -> how many of them each shard takes."""
    load, out = [0] * shards, []
    for size, count in classes:
        out.append(fill(load, size, count))
        load = [x + size * n for x, n in zip(load, out[-1], strict=True)]
    return out


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1), text_crc32 and the group key of each document; a null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.substring(F.sha2(text, 256), 1, 32)).alias("group_key"),
    )


def numbered(rows: DataFrame, by: str, order: list[str], cells: int, name: str) -> DataFrame:
    """Add `name`, 0, 1, 2 ... within each value of `by`, ordered by cell (a hash of `order`) and then by `order`.

    The cells of a value are numbered at once; only their counts (`cells` rows for each value) meet in one window.
    """
    rows = rows.withColumn("cell", F.pmod(F.xxhash64(*order), F.lit(cells)).cast("int"))
    before = Window.partitionBy(by).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(by, "cell").agg(F.count("*").alias("n"))
    starts = counts.select(by, "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = rows.withColumn("k", F.row_number().over(Window.partitionBy(by, "cell").orderBy(*order)))
    return inside.join(starts, [by, "cell"]).withColumn(name, (F.col("start") + F.col("k") - 1).cast("long")).drop("k", "start", "cell")


def assign(items: DataFrame, shards: int = 16, cells: int = SLOT_CELLS) -> DataFrame:
    """Add `shard` to items (group_key, size, ...); rows of equal group_key share a shard. No rows give no rows.

    items is read twice, so pass a stored table.
    """
    groups = cut(items.groupBy("group_key").agg(F.sum("size").alias("bytes")))
    sizes = groups.groupBy("bytes").agg(F.count("*").alias("groups")).orderBy(F.desc("bytes")).toArrow()
    classes = list(zip(sizes["bytes"].to_pylist(), sizes["groups"].to_pylist(), strict=True))
    runs = []
    for got in lpt(classes, shards):
        end, own = 0, []
        for s, n in enumerate(got):
            if n:
                own.append({"end": (end := end + n), "shard": s})
        runs.append(own)
    kind = pa.list_(pa.struct([("end", pa.int64()), ("shard", pa.int32())]))
    table = pa.table({"bytes": pa.array([c[0] for c in classes], pa.int64()), "runs": pa.array(runs, kind)})
    placed = numbered(groups, "bytes", ["group_key"], cells, "number").join(items.sparkSession.createDataFrame(table), "bytes")
    shard = F.filter("runs", lambda r: r["end"] > F.col("number"))[0]["shard"]
    return items.join(placed.select("group_key", shard.alias("shard")), "group_key")


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document, under the law `bytes`.

    Null doc_ids, repeated rows and empty texts are rows like others; repeated rows get slots of their own. Extra
    columns are ignored. An empty table gives no rows. Which of two groups of one size goes where is decided by a hash.
    """
    placed = numbered(cut(assign(cut(sized(docs)), shards)), "shard", ["doc_id", "text_crc32", "size"], SLOT_CELLS, "slot")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot under the law `bytes`; a null text is as large as an empty one, size 1.

    Ties: groups of one size are alike for the schedule and are dealt out in the order of their text's hash. Repeated rows are rows of their group.
    """
    return shard_documents(read(spark, sf_dir, "documents"))
