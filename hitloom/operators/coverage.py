"""Coverage of targets, segments, strains and taxa, and the judgement of which taxa are real."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitloom.operators.hits import label_masked_hits, renormalise_within, spans_on_mask
from hitloom.operators.intervals import BY, clamp, union_length
from hitloom.operators.taxonomy import attach_rank


@dataclass(frozen=True)
class CoverageThresholds:
    min_weighted_breadth: float = 0.01
    min_segment_fraction: float = 0.1
    min_segment_breadth: float = 0.0
    min_segment_covered_bp: int = 200
    min_depth_entropy: float = 0.2
    min_read_count: int = 10
    min_unmasked_weighted_breadth: float = 0.01
    min_unique_fraction: float = 0.0
    require_unique_reads: bool = True


AS_CODED = CoverageThresholds()
DOCUMENTED = CoverageThresholds(min_read_count=3)


def coverage_stats(hits: DataFrame, mask: DataFrame, by: tuple[str, ...] = BY) -> DataFrame:
    """Per target: hit_count, breadth_bp, coverage_ratio and avg_depth of all, masked and unmasked hits, and has_mask.

    All of it comes from one table of depth steps, with the depth of masked hits beside that of all. A ratio's union
    isn't cut at the target's ends; breadth and depth are.
    """
    rows = label_masked_hits(hits, mask)
    m = F.col("is_masked").cast("int")
    step = lambda pos, d, dm, n, nm: F.struct(F.col(pos).alias("pos"), d.alias("d"), dm.alias("dm"), n.alias("n"), nm.alias("nm"))
    zero, one = F.lit(0), F.lit(1)
    events = F.when(F.col("tstart") < F.col("tend"), F.array(step("tstart", one, m, one, m), step("tend", -one, -m, zero, zero))).otherwise(F.array(step("tstart", zero, zero, one, m)))
    steps = rows.select(*by, "tlen", F.inline(events)).groupBy(*by, "pos").agg(F.min("tlen").alias("tlen"), *(F.sum(c).alias(c) for c in ("d", "dm", "n", "nm")))
    order = Window.partitionBy(*by).orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    runs = steps.select(*by, "pos", F.coalesce(F.lead("pos").over(order), "pos").alias("end"), "tlen", "n", "nm", F.sum("d").over(so_far).alias("total"), F.sum("dm").over(so_far).alias("masked"))
    runs = runs.withColumn("unmasked", F.col("total") - F.col("masked")).withColumn("least", F.min("tlen").over(Window.partitionBy(*by)))
    whole = F.col("end") - F.col("pos")
    inside = F.greatest(F.least("end", "least") - F.greatest("pos", F.lit(0)), F.lit(0))
    found = {"total": F.sum("n"), "masked": F.sum("nm"), "unmasked": F.sum(F.col("n") - F.col("nm"))}
    sums = [x for k in found for x in (
        found[k].alias(f"{k}_hit_count"), F.sum(F.when(F.col(k) > 0, inside).otherwise(0)).alias(f"{k}_breadth_bp"),
        F.least(F.lit(1.0), F.coalesce(F.try_divide(F.sum(F.when(F.col(k) > 0, whole).otherwise(0)), F.min("least")), F.lit(0.0))).alias(f"{k}_coverage_ratio"),
        F.coalesce(F.try_divide(F.sum(inside * F.col(k)), F.sum(F.when(F.col(k) > 0, inside).otherwise(0))), F.lit(0.0)).alias(f"{k}_avg_depth"),
    )]
    out = runs.groupBy(*by).agg(*sums)
    there = mask.where("start < end").select("target").distinct().withColumn("has_mask", F.lit(True))
    return out.join(there, "target", "left").withColumn("has_mask", F.coalesce("has_mask", F.lit(False)))


def passing_targets(stats: DataFrame, unmasked: float | None = None, total: float | None = None) -> DataFrame:
    """stats with passed_unmasked, passed_total, passed (each given limit holds) and one of four outcomes."""
    u = F.lit(True) if unmasked is None else F.col("unmasked_coverage_ratio") >= unmasked
    t = F.lit(True) if total is None else F.col("total_coverage_ratio") >= total
    outcome = F.when(u & t, "both").when(u, "unmasked_only").when(t, "total_only").otherwise("neither")
    return stats.select("*", u.alias("passed_unmasked"), t.alias("passed_total"), (u & t).alias("passed"), outcome.alias("outcome"))


def filter_by_coverage(hits: DataFrame, mask: DataFrame, unmasked: float | None = None, total: float | None = None) -> DataFrame:
    """Hits on targets (within a sample) that pass. With an empty mask, every target passes the limit on unmasked coverage."""
    if unmasked is not None and mask.isEmpty():
        unmasked = None
    good = passing_targets(coverage_stats(hits, mask), unmasked, total).where("passed").select("sample", "target")
    return hits.join(good, ["sample", "target"], "left_semi")


def filter_summary(judged: DataFrame) -> DataFrame:
    """passing_targets() -> per sample: passed and failed targets and hits, mean coverage."""
    p = F.col("passed").cast("int")
    return judged.groupBy("sample").agg(
        F.sum(p).alias("passed_targets"), F.sum(1 - p).alias("failed_targets"), F.sum(p * F.col("total_hit_count")).alias("passed_hits"),
        F.sum((1 - p) * F.col("total_hit_count")).alias("failed_hits"), F.avg("total_coverage_ratio").alias("mean_coverage"),
    )


SEGMENT = ("sample", "working_taxid", "segment")
# what candidates, segment_coverage() and strain_coverage() read of a hit; a staged table of hits needs no more
USED = ("sample", "query", "target", "tstart", "tend", "bits", "fident", "working_taxid", "segment", "segment_length")


def segment_coverage(hits: DataFrame, mask: DataFrame, keep_masked_depth: bool = False) -> DataFrame:
    """Per (sample, taxon, segment): length, breadth, unique, multi and masked breadth, average depth, depth entropy.

    hits carry working_taxid, segment, segment_length and is_unique. Depth runs are cut by the mask's regions: without
    keep_masked_depth, masked bases have no depth, and the average is over the segment's unmasked bases (over its length
    if there are none). With it, depth stays and masked_breadth counts the covered masked bases.
    """
    rows = hits.withColumn("tlen", F.col("segment_length"))
    sizes = rows.groupBy(*SEGMENT).agg(F.floor(F.sum("segment_length") / F.count("*")).alias("length"), F.count("*").alias("hits"))
    key = (*SEGMENT, "target")
    inside = clamp(rows).withColumns({"one": F.lit(1), "u": F.col("is_unique").cast("int")})
    # depth, unique depth and regions by place, in one pass over the events; regions are cut to the target
    events = inside.select(*key, F.inline(F.array(F.struct(F.col("tstart").alias("pos"), F.lit(1).alias("d"), F.col("u").alias("du"), F.lit(0).alias("m")), F.struct(F.col("tend").alias("pos"), F.lit(-1).alias("d"), (-F.col("u")).alias("du"), F.lit(0).alias("m")))))
    regions = mask.join(rows.select(*key, "tlen").distinct(), "target").select(*key, F.greatest("start", F.lit(0)).alias("from"), F.least("end", "tlen").alias("to")).where("from < to")
    regions = regions.select(*key, F.inline(F.array(F.struct(F.col("from").alias("pos"), F.lit(0).alias("d"), F.lit(0).alias("du"), F.lit(1).alias("m")), F.struct(F.col("to").alias("pos"), F.lit(0).alias("d"), F.lit(0).alias("du"), F.lit(-1).alias("m")))))
    steps = events.unionByName(regions).groupBy(*key, "pos").agg(F.sum("d").alias("d"), F.sum("du").alias("du"), F.sum("m").alias("m"))
    order = Window.partitionBy(*key).orderBy("pos")
    total = order.rowsBetween(Window.unboundedPreceding, 0)
    runs = steps.select(*key, "pos", F.lead("pos").over(order).alias("end"), F.sum("d").over(total).alias("d"), F.sum("du").over(total).alias("du"), F.sum("m").over(total).alias("m"))
    runs = runs.where("end is not null and (d > 0 or m > 0)").withColumn("n", F.col("end") - F.col("pos"))
    deep = F.col("d") > 0
    seen = deep if keep_masked_depth else deep & (F.col("m") == 0)
    n = F.when(seen, F.col("n")).otherwise(0)
    cover = runs.groupBy(*SEGMENT).agg(
        F.sum(n).alias("breadth_bp"), F.sum(F.when(F.col("du") > 0, n).otherwise(0)).alias("unique_breadth_bp"),
        F.sum(F.when(F.col("du") < F.col("d"), n).otherwise(0)).alias("multi_breadth_bp"),
        F.sum(F.when(deep & (F.col("m") > 0) & F.lit(keep_masked_depth), F.col("n")).otherwise(0)).alias("masked_breadth_bp"),
        F.sum(n * F.col("d")).alias("depth_sum"), F.sum(F.when(n > 0, n * F.col("d") * F.log("d")).otherwise(0.0)).alias("dlogd"),
        F.sum(F.when(F.col("m") > 0, F.col("n")).otherwise(0)).alias("mask_bp"),
    )
    out = sizes.join(cover, list(SEGMENT), "left")
    fill = {c: 0 for c in ("breadth_bp", "unique_breadth_bp", "multi_breadth_bp", "masked_breadth_bp", "depth_sum", "mask_bp")} | {"dlogd": 0.0}
    out = out.fillna(fill)
    effective = F.col("length") - (F.lit(0) if keep_masked_depth else F.col("mask_bp"))
    base = F.when(effective > 0, effective).otherwise(F.col("length"))
    entropy = F.when((F.col("depth_sum") == 0) | (F.col("length") <= 1), 0.0).otherwise((F.log("depth_sum") - F.col("dlogd") / F.col("depth_sum")) / F.log("length"))
    return out.select(*SEGMENT, "length", "hits", "breadth_bp", "unique_breadth_bp", "multi_breadth_bp", "masked_breadth_bp", (F.col("depth_sum") / base).alias("avg_depth"), entropy.alias("depth_entropy"))


def expected_genome_length(references: DataFrame, lineage: DataFrame) -> DataFrame:
    """taxid -> expected_length: the largest of the references of the taxid, and of all taxa of a species for the species."""
    own = references.where("expected_genome_length is not null").groupBy("taxid").agg(F.max("expected_genome_length").alias("x"))
    species = attach_rank(own, lineage, "species", out="s").select(F.col("s").alias("taxid"), "x")
    return own.unionByName(species).groupBy("taxid").agg(F.max("x").alias("expected_length"))


def strain_coverage(hits: DataFrame, segments: DataFrame, mask: DataFrame, references: DataFrame, expected: DataFrame, t: CoverageThresholds = AS_CODED, denominator: str = "expected") -> DataFrame:
    """Per (sample, taxon): breadths over the genome, reads by kind, segments detected and expected.

    The genome is the expected length where that is known and at least the sum of the segments with hits, else that sum.
    """
    key = ["sample", "working_taxid"]
    # a read is one row before it is counted, for all four counts at once
    touched = spans_on_mask(hits, mask, lambda length: F.lit(0)).withColumn("touched", F.lit(1))
    flags = {"unique": F.col("is_unique"), "multi": ~F.col("is_unique"), "masked": F.col("touched") == 1}
    rows = hits.select(*key, "query", "is_unique", "target", "tstart", "tend").join(touched, ["target", "tstart", "tend"], "left")
    rows = rows.groupBy(*key, "query").agg(*(F.max(F.coalesce(f.cast("int"), F.lit(0))).alias(n) for n, f in flags.items()))
    reads = rows.groupBy(*key).agg(F.count("query").alias("total_reads"), *(F.sum(F.when(F.col("query").isNotNull(), F.col(n)).otherwise(0)).alias(f"{n}_reads") for n in flags))
    found = (F.col("breadth_bp") / F.col("length") >= t.min_segment_breadth) | (F.col("breadth_bp") >= t.min_segment_covered_bp)
    sums = segments.groupBy(*key).agg(
        F.sum("length").alias("aligned_length"), F.sum("breadth_bp").alias("breadth_bp"), F.sum("masked_breadth_bp").alias("masked_bp"), F.sum("unique_breadth_bp").alias("unique_breadth_bp"),
        F.sum("multi_breadth_bp").alias("multi_breadth_bp"), F.sum(found.cast("int")).alias("segments_detected"), F.max("depth_entropy").alias("best_entropy"),
        F.avg("depth_entropy").alias("avg_entropy"), F.min("depth_entropy").alias("min_entropy"),
    )
    wanted = references.groupBy(F.col("taxid").alias("working_taxid")).agg(F.count_distinct(F.coalesce("segment_name", "accession")).alias("expected_segments"))
    rows = sums.join(reads, key).join(wanted, "working_taxid", "left").join(expected.withColumnRenamed("taxid", "working_taxid"), "working_taxid", "left")
    use = F.col("expected_length") >= F.col("aligned_length") if denominator == "expected" else F.lit(False)
    genome = F.when(F.coalesce(use, F.lit(False)), F.col("expected_length")).otherwise(F.col("aligned_length"))
    return rows.withColumn("genome_length", genome).select(
        *key, "genome_length", F.try_divide("breadth_bp", "genome_length").alias("weighted_breadth"),
        F.try_divide(F.col("breadth_bp") - F.col("masked_bp"), "genome_length").alias("unmasked_weighted_breadth"), "total_reads", "unique_reads", "multi_reads",
        "masked_reads", "segments_detected", F.coalesce("expected_segments", F.lit(1)).alias("expected_segments"),
        "unique_breadth_bp", "multi_breadth_bp", "best_entropy", "avg_entropy", "min_entropy",
    )


def taxon_coverage(strains: DataFrame, strain_of: DataFrame | None = None) -> DataFrame:
    """Per (sample, taxon): means over its strains of length and breadths. strain_of (working_taxid, taxon) maps strains to taxa."""
    rows = strains.withColumn("taxon", F.col("working_taxid")) if strain_of is None else strains.join(strain_of, "working_taxid")
    return rows.groupBy("sample", "taxon").agg(
        F.avg("genome_length").alias("avg_genome_length"), F.avg("weighted_breadth").alias("weighted_breadth"), F.avg("unmasked_weighted_breadth").alias("unmasked_weighted_breadth"), F.count("*").alias("strain_count"),
    )


def coverage_summary(strains: DataFrame, strain_of: DataFrame | None = None) -> DataFrame:
    """Per (sample, taxon) everything that judge_real() needs, with read totals summed over strains."""
    rows = strains.withColumn("taxon", F.col("working_taxid")) if strain_of is None else strains.join(strain_of, "working_taxid")
    sums = [F.sum(c).alias(c) for c in ("total_reads", "unique_reads", "multi_reads", "masked_reads", "segments_detected", "expected_segments", "unique_breadth_bp", "multi_breadth_bp")]
    return rows.groupBy("sample", "taxon").agg(
        F.count("*").alias("strain_count"), F.avg("genome_length").alias("avg_genome_length"), F.avg("weighted_breadth").alias("weighted_breadth"),
        F.avg("unmasked_weighted_breadth").alias("unmasked_weighted_breadth"), *sums, F.max("best_entropy").alias("best_entropy"), F.avg("avg_entropy").alias("avg_entropy"),
        F.min("min_entropy").alias("min_entropy"),
        F.max((F.col("segments_detected") >= F.greatest(F.lit(1), F.floor(F.col("expected_segments") * 0.1))).cast("int")).alias("segment_ok"),
    )


def judge_real(summary: DataFrame, t: CoverageThresholds = AS_CODED, use_entropy: bool = False, simple: bool = False) -> DataFrame:
    """coverage_summary() with is_real. simple: more unique than multi reads, and enough reads and unmasked breadth.

    Else all of: breadth, a strain with enough segments, unique reads, entropy (if used), enough reads, unmasked breadth,
    and the share of unique reads (off at 0). Reads are the sum of unique and multi reads over strains.
    """
    reads = F.col("unique_reads") + F.col("multi_reads")
    enough = (reads >= t.min_read_count) & (F.col("unmasked_weighted_breadth") >= t.min_unmasked_weighted_breadth)
    if simple:
        return summary.withColumn("is_real", (F.col("unique_reads") > F.col("multi_reads")) & enough)
    ok = (F.col("weighted_breadth") >= t.min_weighted_breadth) & (F.col("segment_ok") == 1) & enough
    if t.require_unique_reads:
        ok = ok & (F.col("unique_reads") > 0)
    if use_entropy:
        ok = ok & (F.coalesce("best_entropy", F.lit(0.0)) >= t.min_depth_entropy)
    if t.min_unique_fraction > 0:
        ok = ok & (F.coalesce(F.try_divide("unique_reads", reads), F.lit(0.0)) >= t.min_unique_fraction)
    return summary.withColumn("is_real", ok)


def fake_taxa(summary: DataFrame) -> DataFrame:
    """The (sample, taxon) of judge_real() that were detected but aren't real, with their reads."""
    return summary.where("not is_real").select("sample", "taxon", "total_reads")


def abundance(assigned: DataFrame, genomes: DataFrame, taxid: str = "working_taxid") -> DataFrame:
    """Per (sample, taxon): read_count, its share, RPK, TPM and the length-normalised share; a length of 0 gives 0.

    genomes: (sample, taxid, avg_genome_length).
    """
    rows = assigned.groupBy("sample", taxid).agg(F.count("*").alias("read_count")).join(genomes, ["sample", taxid], "left")
    rows = rows.withColumn("rpk", F.when(F.col("avg_genome_length") > 0, F.col("read_count") / (F.col("avg_genome_length") / 1000)).otherwise(0.0))
    rows = renormalise_within(rows, "read_count", out="normalized_abundance")
    rows = renormalise_within(rows, "rpk", out="length_norm_abundance")
    return rows.withColumn("tpm", F.col("length_norm_abundance") * 1e6)


def resync_abundance(rows: DataFrame, kept: DataFrame, taxid: str = "working_taxid") -> DataFrame:
    """Abundance rows of the kept (sample, taxid), with TPM renormalised to 1e6 and shares to 1; RPK stays."""
    rows = rows.join(kept.select("sample", taxid).distinct(), ["sample", taxid], "left_semi")
    rows = renormalise_within(rows, "tpm", out="tpm", scale=1e6)
    return renormalise_within(rows, "read_count", out="normalized_abundance")
