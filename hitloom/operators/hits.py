"""Filters and labels on alignment hits (sample, query, target, strand, fident, alnlen, tstart, tend, evalue, bits, qlen, tlen, taxid)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FilterCriteria:
    min_identity: float = 0.8
    min_length: int = 30
    max_evalue: float = 1e-3
    min_query_coverage: float = 0.5


@dataclass(frozen=True)
class QualityCriteria:
    min_identity: float = 0.85
    min_length: int = 60
    min_query_coverage: float = 0.5


# References that are contaminants.
CONTAMINANTS = ["NC_032111.1", "NC_022518.1"]
BIN = 16384  # bases of a target whose mask regions stand in one row
LEVELS = 8  # of nested bins, each eight times as wide; the last one holds everything


def query_coverage() -> Column:
    return F.coalesce(F.try_divide(F.col("alnlen"), F.col("qlen")), F.lit(0.0))


def target_coverage() -> Column:
    return F.coalesce(F.try_divide(F.col("tend") - F.col("tstart"), F.col("tlen")), F.lit(0.0))


def with_query_coverage(hits: DataFrame) -> DataFrame:
    return hits if "qcov" in hits.columns else hits.withColumn("qcov", query_coverage())


def rescale_identity(hits: DataFrame, by: tuple[str, ...] = ("sample", "strand")) -> DataFrame:
    """Divide fident by 100 in those files (sample and strand) where any value is above 1.

    The files' maxima are one row each, so they are aggregated and joined instead of windowed over all hits.
    """
    top = hits.groupBy(*by).agg(F.max("fident").alias("top"))
    return hits.join(top, list(by)).withColumn("fident", F.when(F.col("top") > 1, F.col("fident") / 100).otherwise(F.col("fident"))).drop("top")


def filter_hits(hits: DataFrame, c: FilterCriteria = FilterCriteria()) -> DataFrame:
    hits = with_query_coverage(hits)
    return hits.where((F.col("fident") >= c.min_identity) & (F.col("alnlen") >= c.min_length) & (F.col("evalue") <= c.max_evalue) & (F.col("qcov") >= c.min_query_coverage))


def filter_hits_quality(hits: DataFrame, c: QualityCriteria = QualityCriteria()) -> DataFrame:
    """As filter_hits, without a limit on evalue."""
    hits = with_query_coverage(hits)
    return hits.where((F.col("fident") >= c.min_identity) & (F.col("alnlen") >= c.min_length) & (F.col("qcov") >= c.min_query_coverage))


def drop_contaminants(hits: DataFrame, targets: list[str] = CONTAMINANTS) -> DataFrame:
    return hits.where(~F.col("target").isin(targets))


def blacklist(hits: DataFrame, taxids: list[int] = (), names: list[str] = (), name_column: str = "taxname") -> DataFrame:
    """Drop hits of these taxids, or whose name holds any of these texts, in any case."""
    bad = F.col("taxid").isin(list(taxids)) if taxids else F.lit(False)
    for name in names:
        bad = bad | F.contains(F.lower(F.col(name_column)), F.lit(name.lower()))
    return hits.where(~F.coalesce(bad, F.lit(False)))


def mask_bins(mask: DataFrame) -> DataFrame:
    """target, bin -> regions, an array of the (start, end) that touch the bin of BIN bases."""
    bins = F.sequence(F.floor(F.col("start") / BIN), F.floor(F.col("end") / BIN))
    rows = mask.where("start < end").select("target", "start", "end", F.explode(bins).alias("bin"))
    return rows.groupBy("target", "bin").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("regions"))


def _bin(pos: Column, level: Column) -> Column:
    """The bin of a position at a level: BIN bases at level 0, eight times more at each further one."""
    return F.floor(pos / (F.lit(BIN) * F.pow(F.lit(8), level))).cast("long")


def mask_tree(mask: DataFrame) -> DataFrame:
    """target, level, bin -> regions, an array of the (start, end) whose least bin that holds them is this one; a region stands in one row."""
    rows = mask.where("start < end").select("target", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")).distinct()
    levels = F.sequence(F.lit(0), F.lit(LEVELS - 1))
    level = F.array_min(F.filter(levels, lambda l: (_bin(F.col("start"), l) == _bin(F.col("end") - 1, l)) | (l == LEVELS - 1)))
    rows = rows.withColumn("level", level).withColumn("bin", F.when(F.col("level") == LEVELS - 1, F.lit(0)).otherwise(_bin(F.col("start"), F.col("level"))))
    return rows.groupBy("target", "level", "bin").agg(F.collect_list(F.struct("start", "end")).alias("regions"))


def spans_on_mask(hits: DataFrame, mask: DataFrame, least: Callable[[Column], Column]) -> DataFrame:
    """The distinct (target, tstart, tend) of hits of which a region covers least(length) bases or more, and one at least.

    A span looks its bins up at the levels that its target's regions stand at; at each there are one or two unless it is
    longer than them. Spans on targets without regions go first; regions aren't copied.
    """
    tree = mask_tree(mask)
    levels = tree.groupBy("target").agg(F.collect_set("level").alias("levels"))
    spans = hits.where("tstart < tend").select("target", "tstart", "tend").join(levels, "target").dropDuplicates(["target", "tstart", "tend"])
    last = F.col("level") == LEVELS - 1
    low, high = (F.when(last, F.lit(0).cast("long")).otherwise(_bin(pos, F.col("level"))) for pos in (F.col("tstart"), F.col("tend") - 1))
    rows = spans.select("target", "tstart", "tend", F.explode("levels").alias("level")).select("*", F.explode(F.sequence(low, high)).alias("bin"))
    overlap = lambda r: F.least(F.col("tend"), r["end"]) - F.greatest(F.col("tstart"), r["start"])
    enough = F.exists("regions", lambda r: (overlap(r) > 0) & (overlap(r) >= least(F.col("tend") - F.col("tstart"))))
    return rows.join(tree, ["target", "level", "bin"]).where(enough).select("target", "tstart", "tend").distinct()


def label_masked_hits(hits: DataFrame, mask: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add is_masked: a single region covers at least `threshold` of the hit, and a base of it; hits with tend <= tstart are never masked.

    A region that covers half of a hit holds its middle. So, with a threshold of 0.5 or more, a hit meets the regions of its middle's bin only: one
    equi-join, no hit is multiplied, and no hit sees the regions of a whole chromosome. With a lesser one, the
    distinct spans of hits are looked up in nested bins. A threshold of 0 asks for one base.
    """
    overlap = lambda r: F.least(F.col("tend"), r["end"]) - F.greatest(F.col("tstart"), r["start"])
    if threshold < 0.5:
        found = spans_on_mask(hits, mask, lambda length: threshold * length).withColumn("is_masked", F.lit(True))
        return hits.drop("is_masked").join(found, ["target", "tstart", "tend"], "left").select(*(c for c in hits.columns if c != "is_masked"), F.coalesce("is_masked", F.lit(False)).alias("is_masked"))
    masked = F.exists("regions", lambda r: F.greatest(overlap(r), F.lit(0)) >= threshold * (F.col("tend") - F.col("tstart")))
    label = F.when(F.col("tend") > F.col("tstart"), F.coalesce(masked, F.lit(False))).otherwise(False)
    rows = hits.withColumn("bin", F.floor((F.col("tstart").cast("long") + F.col("tend")) / (2 * BIN)))
    return rows.join(mask_bins(mask), ["target", "bin"], "left").withColumn("is_masked", label).select(*hits.columns, "is_masked")


def drop_all_masked_reads(hits: DataFrame, mask: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Hits that aren't masked: masked ones go, and with them the reads that have no other."""
    return label_masked_hits(hits, mask, threshold).where(~F.col("is_masked")).drop("is_masked")


def masked_read_summary(hits: DataFrame, mask: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per sample: reads, reads with all hits masked, hits, masked hits."""
    reads = label_masked_hits(hits, mask, threshold).groupBy("sample", "query").agg(F.count("*").alias("n"), F.sum(F.col("is_masked").cast("int")).alias("m"))
    return reads.groupBy("sample").agg(
        F.count("*").alias("reads"), F.sum((F.col("n") == F.col("m")).cast("int")).alias("all_masked_reads"), F.sum("n").alias("hits"), F.sum("m").alias("masked_hits")
    )


def masked_read_count(hits: DataFrame, mask: DataFrame, by: tuple[str, ...] = ("sample", "target")) -> DataFrame:
    """Distinct reads with a hit that overlaps a region by one base or more."""
    touched = spans_on_mask(hits, mask, lambda length: F.lit(0))
    rows = hits.select(*dict.fromkeys([*by, "target"]), "query", "tstart", "tend").join(touched, ["target", "tstart", "tend"], "left_semi")
    return rows.groupBy(*by).agg(F.count_distinct("query").alias("masked_reads"))


def split_by_target(hits: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hits on the targets, and the rest."""
    keys = targets.select("target").distinct()
    return hits.join(keys, "target", "left_semi"), hits.join(keys, "target", "left_anti")


def keep_viral(hits: DataFrame, references: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Hits whose taxid is one of the references' or has a name in the taxonomy."""
    keys = references.select("taxid").union(taxonomy.where("name is not null").select("taxid")).distinct()
    return hits.join(keys, "taxid", "left_semi")


def exclude_samples(rows: DataFrame, samples: DataFrame) -> DataFrame:
    return rows.join(samples.select("sample").distinct(), "sample", "left_anti")


def attach_segments(hits: DataFrame, references: DataFrame) -> DataFrame:
    """Add working_taxid, segment and segment_length from the reference of the target; else the hit's own taxid, target and tlen."""
    refs = references.select(F.col("accession").alias("target"), F.col("taxid").alias("ref_taxid"), F.coalesce("segment_name", "accession").alias("ref_segment"), F.col("length").alias("ref_length")).dropDuplicates(["target"])
    return (
        hits.join(refs, "target", "left")
        .withColumn("working_taxid", F.coalesce("ref_taxid", "taxid"))
        .withColumn("segment", F.coalesce("ref_segment", "target"))
        .withColumn("segment_length", F.coalesce("ref_length", "tlen"))
        .drop("ref_taxid", "ref_segment", "ref_length")
    )


def identity_windows(hits: DataFrame, width: int = 100, least: int = 5) -> DataFrame:
    """Mean identity of the hits with their midpoint in each `width` bases of a target, where there are `least` or more."""
    mid = F.floor((F.col("tstart") + F.col("tend")) / 2)
    return hits.groupBy("target", F.floor(mid / width).alias("window")).agg(F.avg("fident").alias("identity"), F.count("*").alias("n")).where(F.col("n") >= least)


def renormalise_within(rows: DataFrame, value: str, by: tuple[str, ...] = ("sample",), out: str = "share", scale: float = 1.0) -> DataFrame:
    """value / its sum within `by`, times scale; 0 where the sum is 0."""
    total = F.sum(value).over(Window.partitionBy(*by))
    return rows.withColumn(out, F.when(total == 0, 0.0).otherwise(F.col(value) / total * scale))
