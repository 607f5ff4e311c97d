"""Whole runs: classification by mode, post-steps, and the merge of samples to tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.functions.stage import stage
from hitloom.operators import assign, counts, coverage, em, hits, host, intervals, ml
from hitloom.operators.taxonomy import attach_rank, attach_taxon


def prepare(rows: DataFrame, mask: DataFrame, quality=hits.QualityCriteria(), min_unmasked: float | None = 0.05) -> DataFrame:
    """Good hits without contaminants, on targets with enough unmasked coverage."""
    rows = hits.drop_contaminants(hits.filter_hits_quality(rows, quality))
    return rows if min_unmasked is None else coverage.filter_by_coverage(rows, mask, unmasked=min_unmasked)


def method_b(rows: DataFrame, mask: DataFrame, least_breadth: float = 0.01, least_reads: int = 3) -> DataFrame:
    """(sample, taxid, read_count): each read's best hit of all; of these, the ones on references that the unmasked best
    hits cover by `least_breadth` or more; taxa with `least_reads` of them or more."""
    best = stage(assign.best_hit_rows(rows))
    ratio = intervals.merged_coverage_ratio(hits.drop_all_masked_reads(best, mask))
    good = ratio.where(F.col("coverage_ratio") >= least_breadth).select("sample", "target")
    counted = best.join(good, ["sample", "target"], "left_semi").groupBy("sample", "taxid").agg(F.count("*").alias("read_count"))
    return counted.where(F.col("read_count") >= least_reads)


def classify_coverage(rows: DataFrame, mask: DataFrame, references: DataFrame, lineage: DataFrame, thresholds=coverage.AS_CODED, rank: str = "species", mode: str = "best_hit", use_entropy: bool = False, denominator: str = "expected") -> dict[str, DataFrame]:
    """assigned reads, abundance and summary by coverage; mode `all` keeps all hits of multi-mapped reads for the coverage."""
    rows = hits.attach_segments(prepare(rows, mask), references)
    rows = attach_rank(rows, lineage, rank, "working_taxid", "rank_taxid").withColumn("working_taxid", F.col("rank_taxid")).where("working_taxid is not null and working_taxid != 0").drop("rank_taxid")
    rows = stage(rows.select(*coverage.USED))
    cands = stage(assign.candidates(rows))
    if mode == "best_hit":
        used = stage(rows.join(assign.best_taxon(cands), ["sample", "query", "working_taxid"]))
    else:
        unique = cands.select("sample", "query", (F.col("candidate_count") == 1).alias("is_unique")).distinct()
        used = stage(rows.join(unique, ["sample", "query"]))
    segments = coverage.segment_coverage(used, mask, use_entropy)
    strains = coverage.strain_coverage(used, segments, mask, references, coverage.expected_genome_length(references, lineage), thresholds, denominator)
    summary = stage(coverage.judge_real(coverage.coverage_summary(strains), thresholds, use_entropy))
    real = summary.where("is_real").select("sample", F.col("taxon").alias("working_taxid"))
    assigned = assign.assign_reads(cands, real)
    abundance = coverage.abundance(assigned, summary.select("sample", F.col("taxon").alias("working_taxid"), "avg_genome_length"))
    return {"assigned": assign.to_assignment_schema(assigned, lineage), "abundance": abundance, "summary": summary}


def classify_lca(rows, mask, references, lineage, fix_rank=None, **_) -> dict[str, DataFrame]:
    return {"assigned": assign.classify_lca(prepare(rows, mask), lineage, fix_rank)}


def classify_lca_conditional(rows, mask, references, lineage, least=0.5, **_) -> dict[str, DataFrame]:
    first = stage(assign.classify_lca(prepare(rows, mask), lineage))
    moved = assign.classify_lca_conditional(first, lineage, least).select("sample", "query", "lca_taxid")
    named = attach_taxon(moved, lineage, "lca_taxid").select("sample", "query", "lca_taxid", F.col("name").alias("lca_name"), F.col("rank").alias("lca_rank"))
    return {"assigned": first.drop("lca_taxid", "lca_name", "lca_rank").join(named, ["sample", "query"])}


def classify_em(rows, mask, references, lineage, rounds=20, tolerance=1e-6, **_) -> dict[str, DataFrame]:
    rows = attach_rank(prepare(rows, mask), lineage, "species", out="species")
    cands = rows.groupBy("sample", "query", "species").agg(F.max("bits").alias("score"))
    lengths = attach_rank(references, lineage, "species", out="species").groupBy("species").agg(F.sum("length").alias("length"))
    share = em.em_abundance(cands, lengths, rounds, tolerance)
    best = em.em_assign(cands, share)
    named = attach_taxon(best, lineage, "species").select("sample", "query", F.col("species").alias("lca_taxid"), F.col("name").alias("lca_name"), F.col("rank").alias("lca_rank"), F.lit(1).alias("read_count"), F.col("candidate_count").alias("n_unique_taxids"))
    return {"assigned": named, "abundance": share}


def classify_ml_filter(rows, mask, references, lineage, model=None, threshold=0.5, **options) -> dict[str, DataFrame]:
    """classify_coverage() without the taxa that the model rejects."""
    out = classify_coverage(rows, mask, references, lineage, **options)
    summary = assign.attach_pair_support(out["summary"], assign.pair_support(rows, lineage))
    scored = ml.score_tp_fp(model, ml.ml_features(summary), threshold)
    good = scored.where("accepted").select("sample", F.col("taxon").alias("lca_taxid"))
    kept = out["assigned"].join(good, ["sample", "lca_taxid"], "left_semi")
    return {"assigned": kept, "abundance": coverage.resync_abundance(out["abundance"], good.withColumnRenamed("lca_taxid", "working_taxid")), "summary": scored}


#: Modes by name; a mode of your own is one more entry.
MODES: dict[str, Callable[..., dict[str, DataFrame]]] = {
    "coverage": classify_coverage, "lca": classify_lca, "lca_conditional": classify_lca_conditional, "em": classify_em, "ml_filter": classify_ml_filter,
}


def classify(mode: str, rows: DataFrame, mask: DataFrame, references: DataFrame, lineage: DataFrame, min_abundance: float = 0.0005, min_unique: float = 0.0, min_reads: int = 0, hosts: DataFrame | None = None, **options) -> dict[str, DataFrame]:
    """A mode, then the post-filter, renormalised abundances, and phages by host if hosts are given."""
    out = MODES[mode](rows, mask, references, lineage, **options)
    out["assigned"] = stage(counts.fp_postfilter(out["assigned"], min_abundance, min_unique, min_reads))
    if "tpm" in getattr(out.get("abundance"), "columns", ()):
        kept = out["assigned"].select("sample", F.col("lca_taxid").alias("working_taxid")).distinct()
        out["abundance"] = coverage.resync_abundance(out["abundance"], kept)
    if hosts is not None:
        out["assigned"] = host.phage_host_rollup(out["assigned"], hosts, lineage)
    out["clades"] = counts.clade_counts(out["assigned"], lineage)
    return out


def merge_otu(assigned: DataFrame, lineage: DataFrame, samples: DataFrame, ranks: tuple[str, ...] = ("genus", "species"), min_count: float = 10, min_samples: int = 1, normalize: bool = False, hosts: DataFrame | None = None, abundance: DataFrame | None = None) -> dict[str, DataFrame]:
    """Tables (long) of all samples: raw, one per rank, phages by host, and if an abundance table is given its read counts
    and TPM, raw and by rank; empty samples are listed apart."""
    out = {"empty": counts.partition_nonempty_samples(assigned, samples).where("is_empty")}
    raw = counts.otu_table(assigned)
    tables = {"raw": raw} | {r: counts.otu_table_at_rank(raw, lineage, r) for r in ranks}
    if hosts is not None:
        tables["phage_host"] = counts.otu_table(host.phage_host_rollup(assigned, hosts, lineage))
    for name, table in tables.items():
        table = counts.filter_otu(table, min_count, min_samples)
        out[name] = counts.normalize_otu(table) if normalize else table
    if abundance is not None:
        for value in ("read_count", "tpm"):
            for rank in (None, *ranks):
                out[f"{value}_{rank or 'raw'}"] = abundance_table(abundance, lineage, value, rank)
    return out


def abundance_table(abundance: DataFrame, lineage: DataFrame, value: str = "tpm", rank: str | None = None) -> DataFrame:
    """(sample, taxid, value) of an abundance column, summed at a rank if one is given."""
    rows = abundance.select("sample", F.col("working_taxid").alias("taxid"), F.col(value).alias("value"))
    return rows if rank is None else counts.otu_table_at_rank(rows, lineage, rank)
