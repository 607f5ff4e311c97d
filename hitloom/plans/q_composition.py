"""Queries on compositions, feature matrices and long tables, and on steps that only whole runs used, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.functions.stage import stage
from hitloom.operators import assign, cohort, composition, coverage, ml, taxonomy
from hitloom.plans import pipelines, q_cohort, q_cover
from hitloom.plans.common_sql import LINEAGE, rank_of
from hitloom.plans.derive import oracle, view

QUERIES, SQL = {}, {}


def query(sql: str | None = None, views: str = "counts cohort refs metadata title_hosts taxonomy"):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = oracle(views, sql)
        return f

    return add


rnd = q_cohort.rnd
# detections in two cohorts; sample c5 has none
_TYPE = "CASE taxid % 7 WHEN 0 THEN 'dsDNA' WHEN 1 THEN 'ssDNA' WHEN 2 THEN 'dsRNA' WHEN 3 THEN 'ssRNA' WHEN 4 THEN 'RT' ELSE 'Other' END"
_COHORT = "concat('k', CAST(CAST(substring(sample, 2) AS INT) % 2 AS STRING))"
_DET = (
    "WITH" + LINEAGE + f",{rank_of('species')},{rank_of('genus', 'upg')},{q_cover.HOSTS}, man AS (SELECT {_COHORT} AS cohort, sample, grp FROM cohort),"
    f" det AS (SELECT m.cohort, m.sample, m.grp, taxid, l.name, reads, reads::DOUBLE * (1 + taxid % 3) AS weight, {_TYPE} AS genome_type, coalesce(is_phage, false) AS is_phage, host, coalesce(upg.an, l.name) AS genus_name"
    " FROM counts JOIN man m USING (sample) JOIN lin l USING (taxid) LEFT JOIN hosts ON species_taxid = taxid LEFT JOIN upg USING (taxid) WHERE sample <> 'c5')"
)


def manifest(spark, d) -> DataFrame:
    return view(spark, d, "cohort").select(F.expr(_COHORT).alias("cohort"), "sample", "group")


def detections(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Detections, hosts and lineages."""
    lineage, hosts = q_cover.lin(spark, d), q_cover.hosts_of(spark, d)
    rows = view(spark, d, "counts").where("sample != 'c5'").join(manifest(spark, d), "sample").join(lineage.select("taxid", "name"), "taxid")
    rows = rows.withColumn("weight", F.col("reads").cast("double") * (1 + F.col("taxid") % 3)).withColumn("genome_type", F.expr(_TYPE))
    return rows, hosts, lineage


def labelled(spark, d) -> DataFrame:
    rows, hosts, lineage = detections(spark, d)
    rows = rows.join(hosts.withColumnRenamed("species_taxid", "taxid"), "taxid", "left")
    return composition.with_genus(rows, lineage)


_SIX = ", ".join(f"coalesce(sum(CASE WHEN genome_type = '{t}' THEN reads END), 0)::BIGINT AS \"{t}_reads\", count(DISTINCT CASE WHEN genome_type = '{t}' THEN taxid END) AS \"{t}_species\"" for t in composition.GENOME_TYPES)


@query(_DET + f" SELECT m.cohort, m.sample, m.grp, {_SIX}, coalesce(sum(reads), 0)::BIGINT AS total_reads, count(DISTINCT taxid) AS total_species FROM man m LEFT JOIN det USING (sample) GROUP BY ALL")
def genome_types_per_sample(spark, d):
    return composition.genome_type_per_sample(detections(spark, d)[0], manifest(spark, d)).withColumnRenamed("group", "grp")


@query(
    _DET + ", k AS (SELECT unnest(['dsDNA', 'ssDNA', 'dsRNA', 'ssRNA', 'RT', 'Other']) AS genome_type), t AS (SELECT cohort, sum(reads) AS r, count(DISTINCT taxid) AS s, sum(weight) AS w FROM det GROUP BY cohort),"
    " o AS (SELECT cohort, genome_type, sum(reads)::BIGINT AS reads, count(DISTINCT taxid) AS species, count(DISTINCT sample) AS samples, sum(weight) AS w FROM det GROUP BY ALL)"
    " SELECT t.cohort, k.genome_type, coalesce(o.reads, 0) AS reads, coalesce(o.species, 0) AS species, coalesce(o.samples, 0) AS samples, round(coalesce(o.w / t.w, 0), 9) AS mean_share, round(coalesce(o.reads::DOUBLE / t.r, 0), 9) AS read_share, round(coalesce(o.species::DOUBLE / t.s, 0), 9) AS species_share"
    " FROM t CROSS JOIN k LEFT JOIN o ON o.cohort = t.cohort AND o.genome_type = k.genome_type"
)
def genome_types_per_cohort(spark, d):
    return rnd(composition.genome_type_per_cohort(detections(spark, d)[0]), "mean_share", "read_share", "species_share")


def _leading_sql(where: str, label: str, by: str, n: int, other: str) -> str:
    return (
        f", own AS (SELECT {by}, sample, {label} AS label, weight / sum(weight) OVER (PARTITION BY cohort, sample) AS w FROM det WHERE {where}), m AS (SELECT {by}, label, sum(w) / sum(sum(w)) OVER (PARTITION BY {by}) AS share FROM own GROUP BY {by}, label),"
        f" top AS (SELECT label FROM m GROUP BY label ORDER BY max(share) DESC, label LIMIT {n})"
        f" SELECT {by}, CASE WHEN label IN (SELECT label FROM top) THEN label ELSE '{other}' END AS label, round(sum(share), 9) AS share FROM m GROUP BY ALL"
    )


@query(_DET + _leading_sql("is_phage AND host IS NOT NULL", "host", "cohort, grp", 3, "Other host"))
def host_genus_composition(spark, d):
    rows, hosts, _ = detections(spark, d)
    out = composition.host_genus_composition(rows, hosts, ("cohort", "group"), 3)
    return rnd(out, "share").withColumnsRenamed({"group": "grp", "host_genus": "label"})


@query(_DET + _leading_sql("NOT is_phage", "genus_name", "cohort, grp", 5, "Other"))
def nonphage_composition(spark, d):
    rows, hosts, lineage = detections(spark, d)
    return rnd(composition.nonphage_composition(rows, hosts, lineage, ("cohort", "group"), 5), "share").withColumnRenamed("group", "grp")


@query(_DET + _leading_sql("NOT is_phage", "name", "cohort", 10, "Other"))
def nonphage_species_composition(spark, d):
    rows, hosts, _ = detections(spark, d)
    return rnd(composition.nonphage_composition(rows, hosts), "share")


_LEVEL = {
    "kind": "CASE WHEN is_phage THEN 'phage' ELSE 'non-phage' END", "host_genus": "CASE WHEN is_phage THEN host END", "nonphage_genus": "CASE WHEN NOT is_phage THEN genus_name END", "nonphage_species": "CASE WHEN NOT is_phage THEN name END",
}
_LEVEL["combined_genus"] = "CASE WHEN is_phage AND host IS NULL THEN 'Other-host phage' WHEN is_phage THEN concat(host, ' phage') ELSE genus_name END"
_LEVEL["combined_species"] = _LEVEL["combined_genus"].replace("genus_name", "name")


def _matrix(level: str, share: bool) -> None:
    def f(spark, d):
        out = composition.level_matrix(labelled(spark, d), manifest(spark, d), level, "weight" if share else "reads", share)
        return rnd(out, "value") if share else out

    f.__name__ = f"matrix_{level}_{'shares' if share else 'counts'}"
    value = "weight / sum(weight) OVER (PARTITION BY sample)" if share else "reads"
    kind = "round(coalesce(v, 0), 9)" if share else "coalesce(v, 0)::BIGINT"
    query(
        _DET + f", own AS (SELECT sample, feature, {value} AS v FROM (SELECT *, {_LEVEL[level]} AS feature FROM det) WHERE feature IS NOT NULL), s AS (SELECT sample, feature, sum(v) AS v FROM own GROUP BY ALL)"
        f" SELECT m.sample, f.feature, {kind} AS value FROM man m CROSS JOIN (SELECT feature FROM s GROUP BY feature HAVING sum(v) > 0) f LEFT JOIN s ON s.sample = m.sample AND s.feature = f.feature"
    )(f)


for _level in _LEVEL:
    _matrix(_level, _level.startswith("combined"))


def species_of(spark, d) -> DataFrame:
    lineage = q_cover.lin(spark, d)
    rows = q_cohort.tools(spark, d).drop("name").join(lineage.select("taxid", "name"), "taxid")
    return cohort.species_long([rows])


_LONG = "WITH" + LINEAGE + f",{rank_of('species')},{rank_of('genus', 'upg')},{q_cover.HOSTS},{q_cohort._TOOLS}, sl AS (SELECT tool, sample, taxid, l.name, sum(reads)::BIGINT AS reads, sum(reads)::DOUBLE / sum(sum(reads)) OVER (PARTITION BY tool, sample) AS rel_abund FROM tl JOIN lin l USING (taxid) GROUP BY tool, sample, taxid, l.name), gl AS (SELECT sl.*, coalesce(a, taxid) AS genus_taxid, coalesce(an, sl.name) AS genus_name FROM sl LEFT JOIN upg USING (taxid))"


@query(_LONG + " SELECT tool, sample, genus_taxid, genus_name, sum(reads)::BIGINT AS reads, round(sum(rel_abund), 9) AS rel_abund FROM gl GROUP BY ALL")
def genus_long(spark, d):
    return rnd(composition.genus_long(species_of(spark, d), q_cover.lin(spark, d)), "rel_abund")


@query(_LONG + ", h AS (SELECT tool, sample, host AS host_genus, sum(reads)::BIGINT AS reads, sum(rel_abund) AS w FROM sl JOIN hosts ON species_taxid = taxid WHERE host IS NOT NULL GROUP BY ALL) SELECT tool, sample, host_genus, reads, round(w / sum(w) OVER (PARTITION BY tool, sample), 9) AS rel_abund FROM h")
def host_long(spark, d):
    return rnd(composition.host_long(species_of(spark, d), q_cover.hosts_of(spark, d)), "rel_abund")


@query(_LONG + " SELECT t.tool, c.sample, count(DISTINCT taxid) AS n_species, count(DISTINCT genus_taxid) AS n_genus, coalesce(sum(reads), 0)::BIGINT AS total_reads FROM (SELECT DISTINCT tool FROM sl) t CROSS JOIN (SELECT DISTINCT sample FROM cohort) c LEFT JOIN (SELECT * FROM gl WHERE reads > 0) g ON g.tool = t.tool AND g.sample = c.sample GROUP BY ALL")
def richness_long(spark, d):
    return composition.richness_long(species_of(spark, d), view(spark, d, "cohort"), q_cover.lin(spark, d))


# --- steps of whole runs


@query(f"SELECT sample, working_taxid AS taxid, round(sum(tpm), 4) AS value FROM ({q_cover.SQL['abundance_tpm']}) GROUP BY ALL", "hits")
def abundance_table(spark, d):
    return rnd(pipelines.abundance_table(q_cover.abundance_of(spark, d), None), "value", digits=4)


@query("WITH" + LINEAGE + f",{rank_of('genus')}, x AS (SELECT * FROM ({q_cover.SQL['abundance_tpm']})) SELECT sample, a AS taxid, sum(read_count)::BIGINT AS value FROM x JOIN up ON up.taxid = working_taxid GROUP BY ALL", "taxonomy")
def abundance_table_at_rank(spark, d):
    return pipelines.abundance_table(q_cover.abundance_of(spark, d), q_cover.lin(spark, d), "read_count", "genus")


@query(f"SELECT sample, taxon, total_reads FROM ({q_cover.SQL['coverage_summary']}) JOIN (SELECT sample, taxon FROM ({q_cover.SQL['judge_real']}) WHERE NOT is_real) USING (sample, taxon)", "hits")
def fake_taxa(spark, d):
    return coverage.fake_taxa(q_cover.classified(spark, d)[1])


_MAJOR = "('family', 'genus', 'species')"


@query(
    "WITH" + LINEAGE + ", k AS (SELECT DISTINCT sample, query, taxid FROM hits JOIN lin USING (taxid)), n AS (SELECT sample, query, count(*) AS n FROM k GROUP BY ALL), x AS (SELECT sample, query, a, ar, d, count(*) AS c FROM k JOIN anc USING (taxid) GROUP BY ALL)"
    f" SELECT sample, query, max(n.n) AS n_taxids, arg_max(a, d) FILTER (ar IN {_MAJOR} AND c = n.n) AS lca_taxid FROM n JOIN x USING (sample, query) GROUP BY ALL", "hits taxonomy",
)
def lca_at_major_rank(spark, d):
    """The LCA of each read, lifted to the nearest major rank."""
    sets = view(spark, d, "hits").select("sample", "query", "taxid")
    return taxonomy.lca_of_sets(sets, q_cover.lin(spark, d), ("sample", "query"), major_only=True).withColumn("n_taxids", F.col("n_taxids").cast("long"))


@query("WITH" + LINEAGE + ", s AS (SELECT * FROM lin WHERE list_contains(ids, 103)) SELECT sample, target, taxid, hit_id FROM hits JOIN s USING (taxid)", "hits taxonomy")
def hits_in_subtree(spark, d):
    return taxonomy.in_subtree(view(spark, d, "hits"), q_cover.lin(spark, d), 103).select("sample", "target", "taxid", "hit_id")


def _support(spark, d) -> DataFrame:
    return assign.pair_support(view(spark, d, "hits").where("taxid % 9 != 0"), q_cover.lin(spark, d))


@query(
    f"SELECT s.sample, s.taxon, s.total_reads, round(coalesce(p.both_frac, 0), 9) AS both_frac FROM ({q_cover.SQL['coverage_summary']}) s LEFT JOIN ("
    "SELECT sample, taxon, sum((m >= 2)::INT)::DOUBLE / count(*) AS both_frac FROM (SELECT h.sample, h.query, coalesce(u.a, h.taxid) AS taxon, count(DISTINCT strand) AS m FROM hits h LEFT JOIN up u ON u.taxid = h.taxid WHERE h.taxid % 9 <> 0 GROUP BY ALL) GROUP BY ALL) p ON p.sample = s.sample AND p.taxon = s.taxon", "hits taxonomy",
)
def pair_support_attached(spark, d):
    rows = assign.attach_pair_support(q_cover.coverage_summary(spark, d), _support(spark, d))
    return rnd(rows.select("sample", "taxon", "total_reads", "both_frac"), "both_frac")


SQL["pair_support_attached"] = SQL["pair_support_attached"].replace("\nSELECT s.sample", "," + LINEAGE + f",{rank_of('species')}\nSELECT s.sample", 1)

_FEATURES = {
    "unique_fraction": "unique_reads::DOUBLE / t", "multi_fraction": "multi_reads::DOUBLE / t", "masked_fraction": "masked_reads::DOUBLE / t", "log_total_reads": "log10(greatest(total_reads, 1))",
    "log_unique_reads": "log10(greatest(unique_reads, 1))", "log_genome_len": "log10(greatest(avg_genome_length, 1))",
    "unique_breadth_frac": "unique_breadth_bp::DOUBLE / CASE WHEN unique_breadth_bp + multi_breadth_bp = 0 THEN 1 ELSE unique_breadth_bp + multi_breadth_bp END",
}


@query(f"SELECT sample, taxon, {', '.join(f'round(coalesce({e}, 0), 7) AS {n}' for n, e in _FEATURES.items())} FROM (SELECT *, CASE WHEN total_reads = 0 THEN 1 ELSE total_reads END AS t FROM ({q_cover.SQL['coverage_summary']}))", "hits")
def ml_features(spark, d):
    return rnd(ml.ml_features(q_cover.coverage_summary(spark, d)), *_FEATURES, digits=7).select("sample", "taxon", *_FEATURES)


@query()
def classify_ml_filter(spark, d):
    """A run by coverage without the taxa that the detection model rejects; the model learns which taxa are true."""
    h, lineage = view(spark, d, "hits"), q_cover.lin(spark, d)
    model = ml.fit_tp_fp_model(stage(q_cohort.labelled_summary(spark, d)))
    out = pipelines.classify_ml_filter(h, view(spark, d, "mask"), view(spark, d, "refs"), lineage, model)
    return out["assigned"].groupBy("sample", "lca_taxid").agg(F.count("*").alias("n"))
