"""Counts by clade and sample: clade and direct counts, post-filters, sample x taxon tables (long) and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitloom.operators.hits import renormalise_within
from hitloom.operators.taxonomy import VIRUSES, attach_rank_strict, rank_map


def clade_counts(assigned: DataFrame, lineage: DataFrame, top: int = VIRUSES) -> DataFrame:
    """Per (sample, taxon): reads of the taxon and all below it, their share of all the sample's reads, depth below `top`, parent.

    Reads are counted by taxid before their paths are unfolded. Negative and unknown taxids are in the total only, and the
    root 1 has no row.
    """
    counts = assigned.groupBy("sample", F.col("lca_taxid").alias("leaf")).agg(F.sum("read_count").alias("n"))
    total = counts.groupBy("sample").agg(F.sum("n").alias("total"))
    paths = lineage.select(F.col("taxid").alias("leaf"), F.explode("path").alias("p"))
    clade = counts.join(paths, "leaf").groupBy("sample", F.col("p.taxid").alias("taxid")).agg(F.sum("n").alias("reads")).where("taxid != 1")
    at = F.array_position(F.col("path")["taxid"], F.lit(top))
    info = lineage.select("taxid", "rank", "name", F.when(at > 0, F.size("path") - at).alias("depth"), F.try_element_at(F.col("path")["taxid"], F.lit(-2)).alias("parent_taxid"))
    return clade.join(info, "taxid").join(total, "sample").select("sample", "taxid", "name", "rank", "reads", (F.col("reads") / F.col("total")).alias("abundance"), "depth", "parent_taxid")


def direct_counts(clades: DataFrame) -> DataFrame:
    """Add direct: the clade's reads less those of its children, 0 at least."""
    below = clades.groupBy("sample", F.col("parent_taxid").alias("taxid")).agg(F.sum("reads").alias("below"))
    return clades.join(below, ["sample", "taxid"], "left").withColumn("direct", F.greatest(F.col("reads") - F.coalesce("below", F.lit(0)), F.lit(0))).drop("below")


def depth_first(clades: DataFrame, lineage: DataFrame) -> DataFrame:
    """Add line: the rank of each clade in depth-first order within its sample, siblings by reads descending, then taxid."""
    steps = lineage.select("taxid", F.posexplode("path").alias("depth_", "p"))
    sizes = clades.select("sample", F.col("taxid").alias("step"), F.col("reads").alias("r"))
    keys = clades.select("sample", "taxid").join(steps, "taxid").join(sizes.withColumnRenamed("sample", "s"), (F.col("p.taxid") == F.col("step")) & (F.col("sample") == F.col("s")))
    keys = keys.groupBy("sample", "taxid").agg(F.array_sort(F.collect_list(F.struct("depth_", (-F.col("r")).alias("r"), F.col("step")))).alias("key"))
    return clades.join(keys, ["sample", "taxid"]).withColumn("line", F.row_number().over(Window.partitionBy("sample").orderBy("key"))).drop("key")


def fp_postfilter(assigned: DataFrame, min_abundance: float = 0.0, min_unique: float = 0.0, min_reads: int = 0) -> DataFrame:
    """Reads of the (sample, taxon) with enough of the sample's reads, enough unique reads among its own, and enough reads.

    All limits look at the same counts, before any is applied; each is off at 0.
    """
    stats = assigned.groupBy("sample", "lca_taxid").agg(F.count("*").alias("n"), F.sum((F.col("n_unique_taxids") == 1).cast("int")).alias("u"))
    total = stats.groupBy("sample").agg(F.sum("n").alias("total"))
    keep = F.lit(True)
    if min_abundance > 0:
        keep = keep & (F.col("n") / F.col("total") >= min_abundance)
    if min_unique > 0:
        keep = keep & (F.col("u") / F.col("n") >= min_unique)
    if min_reads > 0:
        keep = keep & (F.col("n") >= min_reads)
    return assigned.join(stats.join(total, "sample").where(keep).select("sample", "lca_taxid"), ["sample", "lca_taxid"], "left_semi")


def otu_table(rows: DataFrame, value: str = "read_count") -> DataFrame:
    """(sample, taxid, value), summed; zeros are left to the sink."""
    return rows.groupBy("sample", F.col("lca_taxid").alias("taxid")).agg(F.sum(value).alias("value"))


def otu_table_at_rank(otu: DataFrame, lineage: DataFrame, rank: str) -> DataFrame:
    """The table at a rank; taxa without an ancestor of it are dropped, negative (synthetic) ids stay as they are."""
    own = attach_rank_strict(otu.where("taxid > 0"), lineage, rank).select("sample", F.col("rank_taxid").alias("taxid"), "value")
    return own.unionByName(otu.where("taxid < 0").select("sample", "taxid", "value")).groupBy("sample", "taxid").agg(F.sum("value").alias("value"))


def label_taxa(otu: DataFrame, lineage: DataFrame) -> DataFrame:
    """Add label, `name (taxid)`."""
    names = lineage.select("taxid", "name")
    return otu.join(names, "taxid", "left").withColumn("label", F.concat(F.coalesce("name", F.lit("unknown")), F.lit(" ("), F.col("taxid").cast("string"), F.lit(")"))).drop("name")


def filter_otu(otu: DataFrame, min_count: float = 10, min_samples: int = 1, min_prevalence: float = 0.0) -> DataFrame:
    """Taxa with enough in total, in enough samples, and in a large enough share of the table's samples."""
    stats = otu.groupBy("taxid").agg(F.sum("value").alias("total"), F.count_distinct(F.when(F.col("value") > 0, F.col("sample"))).alias("n"))
    keep = F.lit(True)
    if min_count > 0:
        keep = keep & (F.col("total") >= min_count)
    if min_samples > 1:
        keep = keep & (F.col("n") >= min_samples)
    if min_prevalence > 0:
        samples = otu.agg(F.count_distinct("sample").alias("all"))
        stats = stats.crossJoin(F.broadcast(samples))  # one row
        keep = keep & (F.col("n") / F.col("all") >= min_prevalence)
    return otu.join(stats.where(keep).select("taxid"), "taxid", "left_semi")


def normalize_otu(otu: DataFrame) -> DataFrame:
    return renormalise_within(otu, "value", out="value")


def partition_nonempty_samples(rows: DataFrame, samples: DataFrame) -> DataFrame:
    """samples with is_empty: no rows, or no reads."""
    reads = rows.groupBy("sample").agg(F.sum("read_count").alias("n"))
    return samples.select("sample").distinct().join(reads, "sample", "left").select("sample", (F.coalesce("n", F.lit(0)) <= 0).alias("is_empty"))


def taxon_rollups(assigned: DataFrame, lineage: DataFrame, ranks: tuple[str, ...] = ("species", "genus"), bridge: DataFrame | None = None) -> DataFrame:
    """(sample, rank, key, reads, fraction): reads by their ancestor at each rank; what has none is `_unmapped`, so totals stay.

    bridge (taxid, other_taxid) takes taxids to another taxonomy first, of which lineage then is.
    """
    rows = assigned.groupBy("sample", F.col("lca_taxid").alias("taxid")).agg(F.sum("read_count").alias("reads"))
    if bridge is not None:
        rows = rows.join(bridge, "taxid", "left").select("sample", F.col("other_taxid").alias("taxid"), "reads")
    out = None
    for rank in ranks:
        to = rank_map(lineage, rank)
        one = rows.join(to, "taxid", "left").groupBy("sample", F.lit(rank).alias("rank"), F.coalesce("anc_name", F.lit("_unmapped")).alias("key")).agg(F.sum("reads").alias("reads"))
        out = one if out is None else out.unionByName(one)
    return renormalise_within(out, "reads", ("sample", "rank"), "fraction")


def pipeline_step_counts(steps: DataFrame) -> DataFrame:
    """(sample, step, query) -> per sample: distinct reads of raw, qc, nonhost, aligned and confident, and percent of raw."""
    names = ["raw", "qc", "nonhost", "aligned", "confident"]
    out = steps.groupBy("sample").agg(*[F.count_distinct(F.when(F.col("step") == s, F.col("query"))).alias(s) for s in names])
    return out.select("sample", *names, *[(F.try_divide(s, "raw") * 100).alias(f"{s}_pct") for s in names[1:]])
