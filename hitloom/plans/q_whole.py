"""Queries on whole runs and the steps after them, with their SQL: fixed shares and coefficients stand in for fitted ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from hitloom.functions.text import FILE_PARTS, sample_name
from hitloom.operators import em, host, ml
from hitloom.plans import pipelines, q_cohort, q_cover
from hitloom.plans.common_sql import LINEAGE, rank_of
from hitloom.plans.derive import oracle, view
from hitloom.plans.q_cohort import rnd

QUERIES, SQL = {}, {}


def query(sql: str | None = None, views: str = "hits mask refs taxonomy"):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = oracle(views, sql)
        return f

    return add


_FILE = "concat('/data/run', CAST(o_orderkey % 7 AS STRING), '.txt/S', CAST(o_orderkey AS STRING), CASE o_orderkey % 6 WHEN 0 THEN '_R1.fastq.gz' WHEN 1 THEN '_2.fastq' WHEN 2 THEN '.mmseqs.tsv' WHEN 3 THEN '.R2.blast6' WHEN 4 THEN '.fasta' ELSE '' END)"
_NAME = reduce(lambda x, part: f"replace({x}, '{part}', '')", FILE_PARTS, "regexp_extract(f, '([^/]*)$', 1)")


@query(f"SELECT f AS file_name, {_NAME} AS sample FROM (SELECT {_FILE} AS f FROM orders)", "hits")
def sample_names(spark, d):
    rows = spark.read.parquet(f"{d}/orders.parquet").selectExpr(f"{_FILE} AS file_name")
    return rows.select("file_name", sample_name(F.col("file_name")).alias("sample"))


# --- EM with given shares

_FIXED = "fs AS (SELECT sample, species, (1 + species % 7)::DOUBLE / sum(1 + species % 7) OVER (PARTITION BY sample) AS a FROM (SELECT DISTINCT sample, taxid AS species FROM hits)), cd AS (SELECT sample, query, taxid AS species, max(bits) AS score FROM hits GROUP BY ALL), po AS (SELECT c.sample, query, species, CASE WHEN count(*) OVER w = 1 THEN 1 ELSE a * score / sum(a * score) OVER w END AS post, count(*) OVER w AS candidate_count FROM cd c JOIN fs USING (sample, species) WINDOW w AS (PARTITION BY c.sample, query ORDER BY species ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"


@query(f"WITH {_FIXED} SELECT sample, query, species, round(post, 9) AS posterior, candidate_count FROM (SELECT *, row_number() OVER (PARTITION BY sample, query ORDER BY species) AS k FROM (SELECT *, max(post) OVER (PARTITION BY sample, query) AS top FROM po) WHERE post >= top * (1 - 1e-12)) WHERE k = 1", "hits")
def em_assign_given_shares(spark, d):
    cands = q_cohort.em_candidates(spark, d)
    weight = cands.select("sample", "species").distinct().withColumn("w", 1 + F.col("species") % 7)
    share = weight.join(weight.groupBy("sample").agg(F.sum("w").alias("t")), "sample").select("sample", "species", (F.col("w") / F.col("t")).alias("a"))
    return rnd(em.em_assign(cands, share), "posterior")


# --- the detection model with given coefficients

MODEL = {"intercept": -1.5, "weighted_breadth": 2.0, "unique_fraction": 3.0, "log_total_reads": 0.5, "masked_fraction": -4.0, "log_genome_len": -0.25, "best_entropy": 1.25, "strain_count": 0.125, "segments_detected": 0.0625}
_SUM = " + ".join([str(MODEL["intercept"]), "2.0 * coalesce(weighted_breadth, 0)", "3.0 * coalesce(unique_reads::DOUBLE / t, 0)", "0.5 * log10(greatest(total_reads, 1))", "-4.0 * coalesce(masked_reads::DOUBLE / t, 0)", "-0.25 * coalesce(log10(greatest(avg_genome_length, 1)), 0)", "1.25 * coalesce(best_entropy, 0)", "0.125 * coalesce(strain_count, 0)", "0.0625 * coalesce(segments_detected, 0)"])
_SCORED = f"{q_cover.SUMMARY},{q_cover.REAL}, scored AS (SELECT *, 1 / (1 + exp(-({_SUM}))) AS p FROM (SELECT *, CASE WHEN total_reads = 0 THEN 1 ELSE total_reads END AS t FROM real))"


@query(q_cover._ALL + f",{_SCORED} SELECT sample, taxon, round(p, 7) AS tp_probability, p >= 0.4 AS accepted FROM scored")
def scores_of_given_model(spark, d):
    rows = ml.ml_features(q_cover.coverage.coverage_summary(q_cover.strains_of(spark, d)[0]))
    return rnd(ml.score_tp_fp(MODEL, rows, 0.4).select("sample", "taxon", "tp_probability", "accepted"), "tp_probability", digits=7)


# a run takes good hits on targets with enough unmasked coverage, and entropies of all depth
_GOOD = "ph AS (WITH qh AS (SELECT * FROM hits WHERE fident >= 0.85 AND alnlen >= 60 AND alnlen::DOUBLE / qlen >= 0.5)," + q_cover.STATS.removeprefix("WITH").replace("FROM hits h", "FROM qh h") + " SELECT h.* FROM qh h JOIN stats s ON s.sample = h.sample AND s.target = h.target WHERE s.unmasked_coverage_ratio >= 0.05)"
_RUN = f"WITH {LINEAGE},{rank_of('species')},{_GOOD},{q_cover.PREP.replace('FROM hits h', 'FROM ph h')},{q_cover.segments_sql(True)},{q_cover.STRAINS}"


def run_options():
    return {"thresholds": q_cover.STRICT, "use_entropy": True}


@query(_RUN + f",{_SCORED},{q_cover.ASSIGNED} SELECT a.sample, query, working_taxid AS lca_taxid FROM asg a JOIN scored s ON s.sample = a.sample AND s.taxon = a.working_taxid WHERE p >= 0.4")
def ml_filter_given_model(spark, d):
    out = pipelines.classify_ml_filter(view(spark, d, "hits"), view(spark, d, "mask"), view(spark, d, "refs"), q_cover.lin(spark, d), MODEL, 0.4, **run_options())
    return out["assigned"].select("sample", "query", "lca_taxid")


# --- what follows a mode

_POST = "pst AS (SELECT sample, working_taxid, count(*) AS n, count(*) FILTER (candidate_count = 1) AS u, sum(count(*)) OVER (PARTITION BY sample) AS t FROM asg GROUP BY sample, working_taxid), kept AS (SELECT sample, query, working_taxid FROM asg JOIN pst USING (sample, working_taxid) WHERE n::DOUBLE / t >= 0.012 AND u::DOUBLE / n >= 0.1 AND n >= 12)"


def finished(spark, d, **options):
    h, m, r, lineage = view(spark, d, "hits"), view(spark, d, "mask"), view(spark, d, "refs"), q_cover.lin(spark, d)
    return pipelines.classify("coverage", h, m, r, lineage, min_abundance=0.012, min_unique=0.1, min_reads=12, **run_options(), **options)


@query(_RUN + f",{q_cover.SUMMARY},{q_cover.REAL},{q_cover.ASSIGNED},{_POST}, tt AS (SELECT sample, count(*) AS t FROM kept GROUP BY ALL) SELECT k.sample, a AS taxid, count(*) AS reads, round(count(*)::DOUBLE / any_value(t), 9) AS abundance FROM kept k JOIN tt USING (sample) JOIN anc ON anc.taxid = k.working_taxid WHERE a <> 1 GROUP BY k.sample, a")
def post_steps_clades(spark, d):
    return rnd(finished(spark, d)["clades"].select("sample", "taxid", "reads", "abundance"), "abundance")


@query(_RUN + f",{q_cover.SUMMARY},{q_cover.REAL},{q_cover.ASSIGNED},{q_cover.ABUNDANCE},{_POST}, kp AS (SELECT * FROM ab SEMI JOIN kept USING (sample, working_taxid)) SELECT sample, working_taxid, read_count, round(tpm / sum(tpm) OVER (PARTITION BY sample) * 1e6, 4) AS tpm, round(read_count::DOUBLE / sum(read_count) OVER (PARTITION BY sample), 9) AS normalized_abundance FROM kp")
def post_steps_abundance(spark, d):
    return finished(spark, d)["abundance"].select("sample", "working_taxid", "read_count", F.round("tpm", 4).alias("tpm"), F.round("normalized_abundance", 9).alias("normalized_abundance"))


_MERGED = f"raw AS (SELECT sample, lca_taxid AS taxid, sum(read_count)::BIGINT AS value FROM asg GROUP BY ALL),{rank_of('genus', 'ug')},{rank_of('species', 'us')}, allt AS (SELECT 'raw' AS kind, * FROM raw UNION ALL SELECT 'genus', sample, a, sum(value)::BIGINT FROM raw JOIN ug USING (taxid) GROUP BY sample, a UNION ALL SELECT 'species', sample, a, sum(value)::BIGINT FROM raw JOIN us USING (taxid) GROUP BY sample, a), st AS (SELECT kind, taxid, sum(value) AS t, count(DISTINCT CASE WHEN value > 0 THEN sample END) AS n FROM allt GROUP BY ALL), fil AS (SELECT a.* FROM allt a JOIN st USING (kind, taxid) WHERE t >= 60 AND n >= 2)"


@query(q_cover._ASSIGN + f",{_MERGED} SELECT kind, sample, taxid, round(value::DOUBLE / sum(value) OVER (PARTITION BY kind, sample), 9) AS value FROM fil UNION ALL SELECT 'empty', sample, 0, 0 FROM (SELECT DISTINCT sample FROM counts EXCEPT SELECT sample FROM asg)", "hits taxonomy counts")
def merged_tables(spark, d):
    samples = view(spark, d, "counts").select("sample").distinct()
    rows = q_cover.assigned_best(spark, d)
    out = pipelines.merge_otu(rows, q_cover.lin(spark, d), samples, min_count=60, min_samples=2, normalize=True)
    tables = [out[k].select(F.lit(k).alias("kind"), "sample", "taxid", F.round("value", 9).alias("value")) for k in ("raw", "genus", "species")]
    empty = out["empty"].select(F.lit("empty").alias("kind"), "sample", F.lit(0).alias("taxid"), F.lit(0.0).alias("value"))
    return reduce(lambda a, b: a.unionByName(b), [*tables, empty])


# --- hosts of phages by rule

_TITLE = "CASE taxid % 7 WHEN 0 THEN concat('Vibriophage ', CAST(taxid AS STRING)) WHEN 1 THEN concat('Mycobacteriophage L', CAST(taxid AS STRING)) WHEN 2 THEN concat('Cyanophage S-', CAST(taxid AS STRING)) WHEN 3 THEN concat('Vibrio phage ', CAST(taxid AS STRING)) WHEN 4 THEN concat('Marine phage ', CAST(taxid AS STRING)) WHEN 5 THEN 'Bacteriophage T' ELSE 'Some virus' END"
_GENERA = ("Vibrio", "Mycobacterium", "Klebsiella")


@query(f"""WITH{LINEAGE}, cr AS (SELECT taxid FROM anc WHERE lower(an) IN ('crassvirales', 'suoliviridae', 'asia') GROUP BY taxid), r AS (SELECT accession, taxid, {_TITLE} AS title, CASE WHEN accession LIKE '%_0' AND taxid % 3 = 0 THEN 'Kept' ELSE '' END AS host FROM refs)
SELECT accession, CASE WHEN host <> '' THEN host WHEN taxid IN (SELECT taxid FROM cr) THEN 'Bacteroides' WHEN taxid % 7 IN (0, 3) THEN 'Vibrio' WHEN taxid % 7 = 1 THEN 'Mycobacterium' WHEN taxid % 7 = 2 THEN 'Cyanobacteria' ELSE '' END AS host,
  CASE WHEN host <> '' THEN 'given' WHEN taxid IN (SELECT taxid FROM cr) THEN 'clade' WHEN taxid % 7 IN (0, 1, 2) THEN 'stem' WHEN taxid % 7 = 3 THEN 'title' END AS host_rule FROM r""", "refs taxonomy")
def hosts_by_rules(spark, d):
    r = view(spark, d, "refs").selectExpr("accession", "taxid", f"{_TITLE} AS title", "CASE WHEN accession LIKE '%_0' AND taxid % 3 = 0 THEN 'Kept' ELSE '' END AS host")
    genera = spark.createDataFrame([(g,) for g in _GENERA], "name string")
    return host.hosts_by_rules(r, genera, q_cover.lin(spark, d), {"crassvirales": "Bacteroides", "asia": "Bacteroides"}).select("accession", "host", "host_rule")
