"""Phage hosts and the bridge to a second taxonomy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.functions.text import CLADE_HOSTS, STEM_HOSTS, genome_type, host_from_title, host_genus, is_phage, phage_stem, stem_key, unversioned
from hitloom.operators.taxonomy import attach_rank, rank_map


def host_map(references: DataFrame, metadata: DataFrame, title_hosts: DataFrame, lineage: DataFrame) -> DataFrame:
    """species_taxid -> is_phage, host (genus or null).

    A species is a phage if any of its accessions is. A host comes from a clade with a known one, else from the metadata
    of the first accession of each taxid, else from its title; the first taxid with a host names the species'.
    """
    names = lineage.select("taxid", F.col("path")["name"].alias("names"))
    rows = attach_rank(references, lineage, "species", out="species_taxid").join(names, "taxid", "left").withColumn("base", unversioned(F.col("accession")))
    meta = metadata.select(F.col("accession").alias("base"), F.col("host").alias("meta_host")).dropDuplicates(["base"])
    titles = title_hosts.select(F.col("base_accession").alias("base"), F.col("host").alias("title_host")).dropDuplicates(["base"])
    rows = rows.join(meta, "base", "left").join(titles, "base", "left")
    host = F.coalesce(clade_host(F.col("names"), CLADE_HOSTS), host_genus(F.col("meta_host")), host_genus(F.col("title_host")))
    rows = rows.withColumn("phage", is_phage(F.col("title"), F.col("names"))).withColumn("host", host)
    per_taxid = rows.groupBy("species_taxid", "taxid").agg(F.bool_or("phage").alias("phage"), F.min(F.struct("accession", "host")).alias("first"))
    with_host = F.min(F.when(F.col("first.host").isNotNull(), F.struct("taxid", "first.host"))).alias("h")
    return per_taxid.groupBy("species_taxid").agg(F.bool_or("phage").alias("is_phage"), with_host).select("species_taxid", "is_phage", F.col("h.host").alias("host"))


def phage_host_rollup(assigned: DataFrame, hosts: DataFrame, lineage: DataFrame) -> DataFrame:
    """Phages of a known host become `phages_of_<Host>` with a negative id that depends on the name alone; others stay."""
    rows = attach_rank(assigned, lineage, "species", "lca_taxid", "species_taxid").join(hosts.where("is_phage and host is not null"), "species_taxid", "left")
    label = F.concat(F.lit("phages_of_"), F.col("host"))
    known = F.col("host").isNotNull()
    synthetic = -F.pmod(F.xxhash64(label), F.lit(2_000_000_000)) - 1
    return rows.select(
        *[c for c in assigned.columns if c not in ("lca_taxid", "lca_name", "lca_rank")],
        F.when(known, synthetic).otherwise(F.col("lca_taxid")).alias("lca_taxid"),
        F.when(known, label).otherwise(F.col("lca_name")).alias("lca_name"),
        F.when(known, "host_genus").otherwise(F.col("lca_rank")).alias("lca_rank"),
    )


def fill_hosts_from_titles(references: DataFrame, genera: DataFrame) -> DataFrame:
    """(accession, title, host) with blank hosts filled from titles of the form `<Host> phage`, if the host is one of the genera (name)."""
    stem = host_from_title(F.col("title"))
    known = genera.select(F.col("name").alias("stem")).distinct()
    rows = references.withColumn("stem", stem).join(known.withColumn("ok", F.lit(True)), "stem", "left")
    blank = F.coalesce(F.trim("host"), F.lit("")) == ""
    return rows.withColumn("host", F.when(blank & F.col("ok"), F.col("stem")).otherwise(F.col("host"))).drop("stem", "ok")


def clade_host(names: Column, hosts: dict[str, str]) -> Column:
    """The host of the first of the clades (lower case) that a lineage's names hold; null if none."""
    out = None
    for name, found in hosts.items():
        hit = F.array_contains(F.transform(names, F.lower), name)
        out = F.when(hit, found) if out is None else out.when(hit, found)
    return out if out is not None else F.lit(None).cast("string")


def hosts_by_rules(references: DataFrame, genera: DataFrame, lineage: DataFrame, clades: dict[str, str] = CLADE_HOSTS) -> DataFrame:
    """(accession, taxid, title, host, ...) with blank hosts filled, and host_rule: given, clade, stem, title, or null for none.

    In this order: the host of a clade on the lineage; of a title's first word `<X>phage` the host of the stem X, which is a fixed one or
    a genus that differs from X in its ending only; of a title `<Host> phage ...` the host. Hosts of titles must be
    among the genera (name); of several genera with one stem the first in the alphabet counts.
    """
    names = lineage.select("taxid", F.col("path")["name"].alias("names_"))
    stems = genera.groupBy(stem_key(F.col("name")).alias("key_")).agg(F.min("name").alias("genus_"))
    known = genera.select(F.col("name").alias("named_")).distinct()
    rows = references.withColumn("stem_", phage_stem(F.col("title"))).withColumn("key_", stem_key(F.col("stem_"))).withColumn("named_", host_from_title(F.col("title")))
    rows = rows.join(names, "taxid", "left").join(stems, "key_", "left").join(known.withColumn("ok_", F.lit(True)), "named_", "left")
    fixed = F.coalesce(F.create_map(*[F.lit(x) for p in STEM_HOSTS.items() for x in p])[F.col("stem_")], F.col("genus_"))
    rules = {"given": F.nullif(F.trim("host"), F.lit("")), "clade": clade_host(F.col("names_"), clades), "stem": fixed, "title": F.when(F.col("ok_"), F.col("named_"))}
    rule = F.coalesce(*(F.when(x.isNotNull(), name) for name, x in rules.items()))
    filled = F.when(rules["given"].isNotNull(), F.col("host")).otherwise(F.coalesce(*rules.values(), F.col("host")))
    return rows.withColumn("host_rule", rule).withColumn("host", filled).select(*references.columns, "host_rule")


def ictv_bridge(ictv: DataFrame, references: DataFrame) -> DataFrame:
    """taxid -> other_taxid in the second taxonomy: the entry that names the taxid, else the one its references name."""
    direct = ictv.where("ncbi_taxid is not null").groupBy(F.col("ncbi_taxid").alias("taxid")).agg(F.min("taxid").alias("a"))
    through = references.where("ictv_taxid is not null").groupBy("taxid").agg(F.min("ictv_taxid").alias("b"))
    return direct.join(through, "taxid", "full").select("taxid", F.coalesce("a", "b").alias("other_taxid"))


def genome_type_label(taxa: DataFrame, vmr: DataFrame, ictv: DataFrame, lineage: DataFrame, by_clade: DataFrame) -> DataFrame:
    """taxa (taxid, name) with genome_type: by the taxid's composition, else the molecule of the species of that name in the
    second taxonomy, else the type of a clade (name, type) on its lineage, else Other."""
    own = vmr.groupBy(F.col("ncbi_taxid").alias("taxid")).agg(F.min("genome_comp").alias("c1"))
    named = ictv.where("rank = 'species' and molecule is not null").groupBy("name").agg(F.min("molecule").alias("c2"))
    steps = lineage.select("taxid", F.posexplode("path").alias("depth", "p")).select("taxid", "depth", F.col("p.name").alias("name"))
    clade = steps.join(by_clade, "name").groupBy("taxid").agg(F.max_by("type", "depth").alias("c3"))
    rows = taxa.join(own, "taxid", "left").join(named, "name", "left").join(clade, "taxid", "left")
    found = F.when(F.col("c1").isNotNull(), genome_type(F.col("c1"))).when(F.col("c2").isNotNull(), genome_type(F.col("c2")))
    return rows.withColumn("genome_type", F.coalesce(F.nullif(found, F.lit("Other")), "c3", F.lit("Other"))).drop("c1", "c2", "c3")


def species_genome_length(references: DataFrame) -> DataFrame:
    """taxid -> length: the sum of its accessions, without gene records and partial titles unless there are no others."""
    partial = F.startswith("accession", F.lit("NG_")) | F.coalesce(F.lower("title").rlike(r"\b(gene|partial)\b"), F.lit(False))
    rows = references.groupBy("taxid").agg(F.sum(F.when(~partial, F.col("length"))).alias("a"), F.sum("length").alias("b"))
    return rows.select("taxid", F.coalesce("a", "b").alias("length"))


def host_group_tpm(reads: DataFrame, hosts: DataFrame, lengths: DataFrame) -> DataFrame:
    """Phage reads (sample, taxid, reads) by host: reads, mean genome length of the host's members, TPM within the sample."""
    members = hosts.where("is_phage and host is not null").select(F.col("species_taxid").alias("taxid"), "host")
    size = members.join(lengths, "taxid").groupBy("host").agg(F.avg("length").alias("length"))
    rows = reads.join(members, "taxid").groupBy("sample", "host").agg(F.sum("reads").alias("reads")).join(size, "host")
    rows = rows.withColumn("rpk", F.col("reads") / (F.col("length") / 1000))
    return rows.withColumn("tpm", F.col("rpk") / F.sum("rpk").over(Window.partitionBy("sample")) * 1e6)


def walk_up(bridge: DataFrame, lineage: DataFrame, rank: str) -> DataFrame:
    """taxid -> anc_taxid, anc_name at the rank of the second taxonomy (strict)."""
    return bridge.join(rank_map(lineage, rank).withColumnRenamed("taxid", "other_taxid"), "other_taxid").select("taxid", "anc_taxid", "anc_name")
