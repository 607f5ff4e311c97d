"""Compositions of detections: by genome type, phage host and genus, and as feature matrices.

Detections are (cohort, sample, group, taxid, name, reads, weight, ...), weight a share or TPM; further columns they need
are named by each function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.operators.cohort import feature_matrix, mean_composition, top_n_other
from hitloom.operators.hits import renormalise_within
from hitloom.operators.taxonomy import attach_rank

# Genome types in order.
GENOME_TYPES = ["dsDNA", "ssDNA", "dsRNA", "ssRNA", "RT", "Other"]


def genome_type_per_sample(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """The manifest with reads and species of each genome_type, and their totals; samples without detections have zeros."""
    own = lambda t, c: F.when(F.col("genome_type") == t, F.col(c))
    sums = [F.sum(own(t, "reads")).alias(f"{t}_reads") for t in GENOME_TYPES] + [F.count_distinct(own(t, "taxid")).alias(f"{t}_species") for t in GENOME_TYPES]
    wide = manifest.join(rows.groupBy("cohort", "sample").agg(*sums), ["cohort", "sample"], "left")
    wide = wide.fillna(0, [f"{t}_{c}" for t in GENOME_TYPES for c in ("reads", "species")])
    total = lambda c: sum((F.col(f"{t}_{c}") for t in GENOME_TYPES[1:]), F.col(f"{GENOME_TYPES[0]}_{c}"))
    return wide.withColumns({"total_reads": total("reads"), "total_species": total("species")})


def genome_type_per_cohort(rows: DataFrame) -> DataFrame:
    """Per cohort and genome type (all of them): reads, species, samples, shares of both, and the mean composition by weight."""
    kinds = rows.sparkSession.createDataFrame([(t,) for t in GENOME_TYPES], "genome_type string")
    totals = rows.groupBy("cohort").agg(F.sum("reads").alias("all_reads"), F.count_distinct("taxid").alias("all_species"))
    own = rows.groupBy("cohort", "genome_type").agg(F.sum("reads").alias("reads"), F.count_distinct("taxid").alias("species"), F.count_distinct("sample").alias("samples"))
    mean = mean_composition(rows, ("cohort",), "genome_type", "weight").withColumnRenamed("share", "mean_share")
    out = totals.join(F.broadcast(kinds)).join(own, ["cohort", "genome_type"], "left").join(mean, ["cohort", "genome_type"], "left")  # six kinds
    out = out.fillna(0, ["reads", "species", "samples"]).fillna(0.0, ["mean_share"])
    share = lambda c: F.coalesce(F.try_divide(c, f"all_{c}"), F.lit(0.0))
    return out.select("cohort", "genome_type", "reads", "species", "samples", "mean_share", share("reads").alias("read_share"), share("species").alias("species_share"))


def _leading(rows: DataFrame, by: tuple[str, ...], label: str, n: int, other: str) -> DataFrame:
    """Mean composition by weight, renormalised within each sample; labels but the n with the largest shares are one."""
    own = renormalise_within(rows, "weight", ("cohort", "sample"), "weight")
    best = top_n_other(mean_composition(own, by, label, "weight"), label, "share", n)
    best = best.withColumn(label, F.when(F.col(label) == "Other", other).otherwise(F.col(label)))
    return best.groupBy(*by, label).agg(F.sum("share").alias("share"))


def host_genus_composition(rows: DataFrame, hosts: DataFrame, by: tuple[str, ...] = ("cohort",), n: int = 10) -> DataFrame:
    """Phages by the genus of their host (hosts: species_taxid, is_phage, host), `by` cohort, or cohort and group."""
    known = hosts.where("is_phage and host is not null").select(F.col("species_taxid").alias("taxid"), F.col("host").alias("host_genus"))
    return _leading(rows.join(known, "taxid"), by, "host_genus", n, "Other host")


def nonphage_composition(rows: DataFrame, hosts: DataFrame, lineage: DataFrame | None = None, by: tuple[str, ...] = ("cohort",), n: int = 10) -> DataFrame:
    """All that isn't a phage by name, or by genus if a lineage is given (a taxon without a genus keeps its name)."""
    phages = hosts.where("is_phage").select(F.col("species_taxid").alias("taxid"))
    others = rows.join(phages, "taxid", "left_anti")
    return _leading(others.withColumn("label", F.col("name")) if lineage is None else with_genus(others, lineage).withColumn("label", F.col("genus_name")), by, "label", n, "Other")


def with_genus(rows: DataFrame, lineage: DataFrame) -> DataFrame:
    """Add genus_taxid and genus_name: the taxon itself where it has no genus."""
    names = lineage.select(F.col("taxid").alias("genus_taxid"), F.col("name").alias("known"))
    rows = attach_rank(rows, lineage, "genus", out="genus_taxid").join(names, "genus_taxid", "left")
    return rows.withColumn("genus_name", F.coalesce("known", "name")).drop("known")


def feature_of(level: str) -> Column:
    """The feature of a detection at a level, null if it has none there; detections carry is_phage, host, genus_name and name.

    kind; host_genus (phages with a host); nonphage_genus; nonphage_species; combined_genus and combined_species (phages
    by host, others by genus or name).
    """
    phage = F.coalesce(F.col("is_phage"), F.lit(False))
    of_host = F.when(F.col("host").isNotNull(), F.concat("host", F.lit(" phage"))).otherwise("Other-host phage")
    return {
        "kind": F.when(phage, "phage").otherwise("non-phage"),
        "host_genus": F.when(phage, F.col("host")),
        "nonphage_genus": F.when(~phage, F.col("genus_name")),
        "nonphage_species": F.when(~phage, F.col("name")),
        "combined_genus": F.when(phage, of_host).otherwise(F.col("genus_name")),
        "combined_species": F.when(phage, of_host).otherwise(F.col("name")),
    }[level]


def level_matrix(rows: DataFrame, manifest: DataFrame, level: str, value: str = "reads", share: bool = False) -> DataFrame:
    """(sample, feature, value) of all samples of the manifest at a level; share: values sum to 1 within each sample."""
    own = rows.withColumn("feature", feature_of(level)).where("feature is not null")
    if share:
        own = renormalise_within(own, value, ("sample",), value)
    return feature_matrix(own, manifest, "feature", value)


def genus_long(species: DataFrame, lineage: DataFrame) -> DataFrame:
    """species_long() summed by genus: reads, and rel_abund from the species' weights."""
    return with_genus(species, lineage).groupBy("tool", "sample", "genus_taxid", "genus_name").agg(F.sum("reads").alias("reads"), F.sum("rel_abund").alias("rel_abund"))


def host_long(species: DataFrame, hosts: DataFrame) -> DataFrame:
    """species_long() by host genus: reads, and rel_abund within those taxa of (tool, sample) that have a host."""
    known = hosts.where("host is not null").select(F.col("species_taxid").alias("taxid"), F.col("host").alias("host_genus"))
    rows = species.join(known, "taxid").groupBy("tool", "sample", "host_genus").agg(F.sum("reads").alias("reads"), F.sum("rel_abund").alias("rel_abund"))
    return renormalise_within(rows, "rel_abund", ("tool", "sample"), "rel_abund")


def richness_long(species: DataFrame, manifest: DataFrame, lineage: DataFrame) -> DataFrame:
    """(tool, sample): n_species, n_genus and total_reads, with zeros for samples of the manifest without detections."""
    rows = with_genus(species.where("reads > 0"), lineage)
    found = rows.groupBy("tool", "sample").agg(F.count_distinct("taxid").alias("n_species"), F.count_distinct("genus_taxid").alias("n_genus"), F.sum("reads").alias("total_reads"))
    grid = manifest.select("sample").distinct().join(species.select("tool").distinct())  # the table itself
    return grid.join(found, ["tool", "sample"], "left").fillna(0, ["n_species", "n_genus", "total_reads"])
