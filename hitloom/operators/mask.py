"""Building mask regions from similarity hits (HSPs): hsp (query, hit, alen, pid, strand, qf, qt, hf, ht)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.operators.intervals import islands, union_length, with_islands


def hsp_filter(hsps: DataFrame, min_length: int = 150, min_identity: float = 90.0, drop_self: bool = False) -> DataFrame:
    """Long and similar HSPs, with coordinates in order."""
    rows = hsps.where((F.col("alen") >= min_length) & (F.col("pid") >= min_identity))
    if drop_self:
        rows = rows.where("query != hit")
    return rows.withColumns({"qf": F.least("qf", "qt"), "qt": F.greatest("qf", "qt"), "hf": F.least("hf", "ht"), "ht": F.greatest("hf", "ht")})


def hsp_to_intervals(hsps: DataFrame, side: str = "query") -> DataFrame:
    """(acc, other, start, end), 0-based and half-open, of the query's or the hit's side (1-based, inclusive)."""
    a, b, f, t = ("query", "hit", "qf", "qt") if side == "query" else ("hit", "query", "hf", "ht")
    return hsps.select(F.col(a).alias("acc"), F.col(b).alias("other"), (F.col(f) - 1).alias("start"), F.col(t).alias("end"))


def merge_with_depth(intervals: DataFrame) -> DataFrame:
    """Merged regions per (acc, other) with the mean depth of their intervals: their summed lengths over the region's."""
    key = ("acc", "other")
    rows = with_islands(intervals, key).groupBy(*key, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("bases"))
    return rows.select(*key, "start", "end", "n", (F.col("bases") / (F.col("end") - F.col("start"))).alias("mean_depth"))


def merge_bed(regions: DataFrame, gap: int = 0) -> DataFrame:
    """Regions (acc, desc, start, end, depth, other) merged per (acc, desc) where they overlap or touch; depths and partners are listed."""
    key = ("acc", "desc")
    listed = F.array_sort(F.collect_list(F.struct("start", "end", "other", "depth")))
    rows = with_islands(regions, key, gap).groupBy(*key, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), listed.alias("x"))
    return rows.select(*key, "start", "end", F.array_join(F.col("x")["depth"].cast("array<string>"), ";").alias("depths"), F.array_join(F.col("x")["other"], ";").alias("others"))


def partial_cds_mask(records: DataFrame) -> DataFrame:
    """The whole length of records (acc, desc, length) described as partial cds."""
    return records.where(F.contains(F.lower("desc"), F.lit("partial cds"))).select("acc", F.lit(0).alias("start"), F.col("length").alias("end"), F.lit("partial_cds").alias("source"))


def assemble_mask(sources: list[DataFrame], gap: int = 30) -> DataFrame:
    """(acc, start, end, source) of all sources without exact duplicates, merged within each source over gaps of up to `gap`."""
    rows = sources[0]
    for other in sources[1:]:
        rows = rows.unionByName(other)
    return islands(rows.dropDuplicates(["acc", "start", "end", "source"]), ("acc", "source"), gap)


def mask_fraction_report(mask: DataFrame, records: DataFrame, warn: float = 0.8) -> DataFrame:
    """records (acc, family, length) -> per family: accessions, mean and median masked share, how many are above `warn`."""
    covered = union_length(mask.select("acc", F.col("start").alias("tstart"), F.col("end").alias("tend")), ("acc",))
    rows = records.join(covered, "acc", "left").withColumn("share", F.coalesce("covered", F.lit(0)) / F.col("length"))
    return rows.groupBy("family").agg(F.count("*").alias("accessions"), F.avg("share").alias("mean_share"), F.percentile("share", 0.5).alias("median_share"), F.sum((F.col("share") > warn).cast("int")).alias("over"))


def cluster_median_identity(pairs: DataFrame, least: float = 50.0) -> DataFrame:
    """Clusters (cluster, pid) whose median identity is at least `least`."""
    return pairs.groupBy("cluster").agg(F.percentile("pid", 0.5).alias("median_pid"), F.count("*").alias("n")).where(F.col("median_pid") >= least)


def hsp_summary(hsps: DataFrame) -> DataFrame:
    """Per hit: HSPs, median length and identity, share on the plus strand, and the window of the query they cover."""
    return hsps.groupBy("hit").agg(
        F.count("*").alias("n"), F.percentile("alen", 0.5).alias("median_length"), F.percentile("pid", 0.5).alias("median_identity"),
        (F.sum((F.col("strand") == "+").cast("int")) / F.count("*")).alias("plus_share"), F.min("qf").alias("window_start"), F.max("qt").alias("window_end"),
    )
