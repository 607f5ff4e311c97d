"""Unions, depths and entropies of half-open intervals, by events and windows; never a row for each base."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BY = ("sample", "target")


def _covered(intervals: DataFrame, by: tuple[str, ...], start: str, end: str, *more: tuple[Column, Column]) -> DataFrame:
    """by -> covered (bases in the union) and further sums, in one pass: `more` has aggregates of the rows of a place, and of places.

    Intervals of one start are one row before the window; an empty interval covers nothing.
    """
    rows = intervals.select(*by, F.col(start).alias("s"), F.greatest(start, end).alias("e"), *(c for c in intervals.columns if c not in (*by, "s", "e"))).groupBy(*by, "s").agg(F.max("e").alias("e"), *(one for one, _ in more))
    before = Window.partitionBy(*by).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("e") - F.greatest("s", F.coalesce(F.max("e").over(before), F.col("s"))))
    return rows.withColumn("fresh", fresh).groupBy(*by).agg(F.sum("fresh").alias("covered"), *(all_ for _, all_ in more))


def union_length(intervals: DataFrame, by: tuple[str, ...] = BY, start: str = "tstart", end: str = "tend") -> DataFrame:
    """by -> covered (bases in the union). Intervals with start >= end are ignored."""
    return _covered(intervals.where(F.col(start) < F.col(end)), by, start, end)


def merged_coverage_ratio(hits: DataFrame, by: tuple[str, ...] = BY) -> DataFrame:
    """by -> coverage_ratio: union length over tlen, at most 1; ends beyond the target aren't clamped."""
    rows = _covered(hits, by, "tstart", "tend", (F.min("tlen").alias("tlen"), F.min("tlen").alias("tlen")))
    return rows.select(*by, F.least(F.lit(1.0), F.coalesce(F.try_divide("covered", "tlen"), F.lit(0.0))).alias("coverage_ratio"))


def clamp(hits: DataFrame) -> DataFrame:
    return hits.withColumn("tstart", F.greatest("tstart", F.lit(0))).withColumn("tend", F.least("tend", "tlen")).where("tstart < tend")


def breadth_depth(hits: DataFrame, by: tuple[str, ...] = BY) -> DataFrame:
    """by -> breadth_bp (covered bases within the target) and avg_depth (over covered bases)."""
    bases = F.sum(F.col("tend") - F.col("tstart")).alias("bases")
    rows = _covered(clamp(hits), by, "tstart", "tend", (bases, F.sum("bases").alias("bases")))
    return rows.select(*by, F.col("covered").alias("breadth_bp"), (F.col("bases") / F.col("covered")).alias("avg_depth"))


def depth_segments(hits: DataFrame, by: tuple[str, ...] = BY, weight: str | None = None) -> DataFrame:
    """Runs (by, start, end, depth) of equal depth above 0; weight: a column to sum instead of counting.

    Starts and ends are summed per place first, so the window sees one row for each place where depth changes.
    """
    w = F.lit(1) if weight is None else F.col(weight)
    events = hits.where("tstart < tend").select(*by, F.inline(F.array(F.struct(F.col("tstart").alias("pos"), w.alias("d")), F.struct(F.col("tend").alias("pos"), (-w).alias("d")))))
    steps = events.groupBy(*by, "pos").agg(F.sum("d").alias("d")).where("d != 0")
    order = Window.partitionBy(*by).orderBy("pos")
    runs = steps.withColumn("depth", F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("end", F.lead("pos").over(order))
    return runs.where("depth != 0 and end is not null").select(*by, F.col("pos").alias("start"), "end", "depth")


def depth_entropy(runs: DataFrame, lengths: DataFrame, by: tuple[str, ...] = BY) -> DataFrame:
    """by -> depth_entropy: -sum p ln p / ln(length), p a base's share of all depth; 0 when there is none."""
    total = runs.groupBy(*by).agg(
        F.sum((F.col("end") - F.col("start")) * F.col("depth")).alias("t"),
        F.sum((F.col("end") - F.col("start")) * F.col("depth") * F.log("depth")).alias("u"),
    )
    h = (F.log("t") - F.col("u") / F.col("t")) / F.log("tlen")
    return lengths.join(total, list(by), "left").select(*by, F.when(F.col("t").isNull() | (F.col("tlen") <= 1), 0.0).otherwise(h).alias("depth_entropy"))


def with_islands(intervals: DataFrame, by: tuple[str, ...], gap: int = 0) -> DataFrame:
    """The intervals with `island`, a number for those that overlap, touch, or lie at most `gap` apart; empty ones are left out."""
    order = Window.partitionBy(*by).orderBy("start", "end")
    top = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = intervals.where("start < end").withColumn("new", F.coalesce((F.col("start") > top + gap).cast("int"), F.lit(1)))
    return rows.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("new")


def islands(intervals: DataFrame, by: tuple[str, ...], gap: int = 0) -> DataFrame:
    """Merged intervals (by, start, end, n) of those that overlap, touch, or lie at most `gap` apart."""
    return with_islands(intervals, by, gap).groupBy(*by, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n")).drop("island")


def reference_depth_track(runs: DataFrame, segments: DataFrame) -> DataFrame:
    """Depth runs of targets laid end to end: segments (virus, target, length) give each target its offset, by name."""
    order = Window.partitionBy("virus").orderBy("target").rowsBetween(Window.unboundedPreceding, -1)
    offset = segments.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0)))
    return runs.join(offset, "target").select("sample", "virus", (F.col("start") + F.col("offset")).alias("start"), (F.col("end") + F.col("offset")).alias("end"), "depth")
