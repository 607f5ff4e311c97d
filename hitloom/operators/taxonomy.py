"""Taxonomies: lineages, ranks, lowest common ancestors. A taxonomy is (taxid, parent_taxid, rank, name)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitloom.functions.stage import stage
from hitloom.functions.text import is_major_rank, normalize_rank, rank_code

VIRUSES = 10239


def one_row_each(taxonomy: DataFrame) -> DataFrame:
    """One row for each taxid: of several the one with the least parent, then the least of the other columns in their order; nulls come last."""
    order = ["parent_taxid", *(c for c in taxonomy.columns if c not in ("taxid", "parent_taxid"))]
    first = F.row_number().over(Window.partitionBy("taxid").orderBy(*(F.asc_nulls_last(c) for c in order)))
    return taxonomy.withColumn("first_", first).where("first_ = 1").drop("first_")


def lineages(taxonomy: DataFrame, root: int = 1) -> DataFrame:
    """taxid, rank, name, path (array of taxid, rank, name from root to taxid) and depth (0 at the root), of any depth.

    Paths are doubled: each round puts the path of the taxon above a path in front of it, so a tree of depth d takes
    log2(d) joins. Null ranks are `no rank`; taxa that don't lead to root, cycles among them, are left out. Of several rows
    of a taxid one counts, see one_row_each(). The result is a table of its own.
    """
    nodes = one_row_each(taxonomy.select("taxid", "parent_taxid", normalize_rank(F.col("rank")).alias("rank"), "name"))
    nodes = nodes.where((F.col("taxid") == root) | (F.col("taxid") != F.col("parent_taxid")))
    above = F.when(F.col("taxid") != root, F.col("parent_taxid")).alias("above")
    rows = nodes.select("taxid", "rank", "name", above, F.array(F.struct("taxid", "rank", "name")).alias("path"))
    while True:
        upper = rows.select(F.col("taxid").alias("above"), F.col("path").alias("more"), F.col("above").alias("next"))
        longer = rows.where("above is not null").join(upper, "above").select("taxid", "rank", "name", F.col("next").alias("above"), F.concat("more", "path").alias("path"))
        circular = F.coalesce(F.array_contains(F.col("path")["taxid"], F.col("above")), F.lit(False))
        rows = stage(rows.where("above is null").unionByName(longer.where(~circular)))
        if rows.where("above is not null").isEmpty():
            return rows.select("taxid", "rank", "name", "path", (F.size("path") - 1).alias("depth"))


def subtree(lineage: DataFrame, root: int = VIRUSES) -> DataFrame:
    """The taxa at or below root, with their depth below it."""
    at = F.array_position(F.col("path")["taxid"], F.lit(root))
    return lineage.where(at > 0).select("taxid", "rank", "name", (F.size("path") - at).cast("int").alias("depth"))


def rank_map(lineage: DataFrame, rank: str) -> DataFrame:
    """taxid -> anc_taxid, anc_name of its nearest ancestor (or itself) of the rank; taxa without one are left out."""
    found = F.try_element_at(F.filter("path", lambda p: p["rank"] == rank), F.lit(-1))
    return lineage.select("taxid", found.alias("a")).where("a is not null").select("taxid", F.col("a.taxid").alias("anc_taxid"), F.col("a.name").alias("anc_name"))


def attach_rank(rows: DataFrame, lineage: DataFrame, rank: str, taxid: str = "taxid", out: str = "rank_taxid") -> DataFrame:
    """Add the ancestor at the rank, or the taxid itself where it has none."""
    to = rank_map(lineage, rank).select(F.col("taxid").alias(taxid), F.col("anc_taxid").alias(out))
    return rows.join(to, taxid, "left").withColumn(out, F.coalesce(out, taxid))


def attach_rank_strict(rows: DataFrame, lineage: DataFrame, rank: str, taxid: str = "taxid", out: str = "rank_taxid") -> DataFrame:
    """Add the ancestor at the rank; rows without one are dropped."""
    to = rank_map(lineage, rank).select(F.col("taxid").alias(taxid), F.col("anc_taxid").alias(out))
    return rows.join(to, taxid)


def attach_taxon(rows: DataFrame, lineage: DataFrame, taxid: str = "taxid") -> DataFrame:
    """Add name, rank, rank_code and lineage (taxids joined by `|`; "0" for an unknown taxid)."""
    info = lineage.select(F.col("taxid").alias(taxid), "name", "rank", rank_code(F.col("rank")).alias("rank_code"), F.array_join(F.col("path")["taxid"].cast("array<string>"), "|").alias("lineage"))
    return rows.join(info, taxid, "left").withColumn("lineage", F.coalesce("lineage", F.lit("0")))


def in_subtree(rows: DataFrame, lineage: DataFrame, root: int = VIRUSES) -> DataFrame:
    return rows.join(subtree(lineage, root).select("taxid"), "taxid", "left_semi")


def lca_of_arrays(rows: DataFrame, lineage: DataFrame, major_only: bool = False) -> DataFrame:
    """rows (..., ids: an array of taxids) -> the other columns, lca_taxid and n_taxids. Unknown ids and ids <= 0 are ignored; rows with none left go.

    The LCA is the last taxon that the paths of all ids have in common (of major ranks, if only these count; null if
    there is none). Paths are joined once for each distinct set of ids.
    """
    keys = [c for c in rows.columns if c != "ids"]
    rows = rows.withColumn("ids", F.array_sort(F.array_distinct("ids")))
    path = F.filter("path", lambda p: is_major_rank(p["rank"])) if major_only else F.col("path")
    paths = lineage.select("taxid", path["taxid"].alias("steps"))
    members = rows.select("ids").distinct().select("ids", F.explode("ids").alias("taxid")).where("taxid > 0").join(paths, "taxid")
    sets = members.groupBy("ids").agg(F.collect_list("steps").alias("paths"))
    common = F.aggregate("paths", F.col("paths")[0], F.array_intersect)
    found = sets.select("ids", F.try_element_at(common, F.lit(-1)).alias("lca_taxid"), F.size("paths").alias("n_taxids"))
    return rows.join(found, "ids").select(*keys, "lca_taxid", "n_taxids")


def lca_of_sets(sets: DataFrame, lineage: DataFrame, key: tuple[str, ...], major_only: bool = False) -> DataFrame:
    """sets (key, taxid) -> key, lca_taxid, n_taxids, as lca_of_arrays()."""
    groups = sets.where("taxid > 0").groupBy(*key).agg(F.collect_set("taxid").alias("ids"))
    return lca_of_arrays(groups, lineage, major_only)


def major_tree(lineage: DataFrame) -> DataFrame:
    """taxid, parent_taxid of the taxa of major ranks, each under its nearest major ancestor (null at the top)."""
    major = F.filter("path", lambda p: is_major_rank(p["rank"]))
    rows = lineage.where(is_major_rank(F.col("rank"))).withColumn("m", major)
    return rows.select("taxid", "rank", F.try_element_at(F.col("m")["taxid"], F.lit(-2)).alias("parent_taxid"))


def is_ancestor(pairs: DataFrame, lineage: DataFrame) -> DataFrame:
    """pairs (ancestor, taxid) with is_ancestor."""
    return pairs.join(lineage.select("taxid", F.col("path")["taxid"].alias("ids")), "taxid", "left").withColumn("is_ancestor", F.coalesce(F.array_contains("ids", F.col("ancestor")), F.lit(False))).drop("ids")


def search_names(taxonomy: DataFrame, text: str, limit: int | None = None) -> DataFrame:
    """Taxa whose name holds the text, in any case, in order of name."""
    found = taxonomy.where(F.contains(F.lower("name"), F.lit(text.lower()))).orderBy("name", "taxid")
    return found if limit is None else found.limit(limit)


def verify_taxonomy(taxonomy: DataFrame) -> DataFrame:
    """One row: taxa, has_root, has_viruses, unnamed, orphans (parents that don't exist)."""
    parents = taxonomy.select(F.col("taxid").alias("parent_taxid"), F.lit(1).alias("there")).distinct()
    return taxonomy.join(parents, "parent_taxid", "left").agg(
        F.count("*").alias("taxa"), F.bool_or(F.col("taxid") == 1).alias("has_root"), F.bool_or(F.col("taxid") == VIRUSES).alias("has_viruses"),
        F.count_if(F.col("name").isNull()).alias("unnamed"), F.count_if(F.col("there").isNull()).alias("orphans"),
    )


def segment_info(references: DataFrame, lineage: DataFrame) -> DataFrame:
    """accession -> segment, length, species_taxid, is_segmented."""
    rows = attach_rank(references, lineage, "species", out="species_taxid")
    return rows.select("accession", F.coalesce("segment_name", "accession").alias("segment"), "length", "species_taxid", "is_segmented")


def descendants_at_rank(values: DataFrame, lineage: DataFrame, rank: str, under: int) -> DataFrame:
    """(sample, taxid, value) summed at the rank below `under`: sample, rank_taxid, lineage text, value, proportion of the sample."""
    below = lineage.where(F.array_contains(F.col("path")["taxid"], under))
    rows = attach_rank_strict(values, below, rank).groupBy("sample", "rank_taxid").agg(F.sum("value").alias("value"))
    text = lineage.select(F.col("taxid").alias("rank_taxid"), F.array_join(F.col("path")["name"], ";").alias("lineage"))
    share = F.col("value") / F.sum("value").over(Window.partitionBy("sample"))
    return rows.join(text, "rank_taxid").withColumn("proportion", share)
