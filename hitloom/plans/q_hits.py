"""Queries on hits, intervals, masks and taxonomies, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from hitloom.functions import text as T
from hitloom.operators import assign, hits, intervals, mask, taxonomy
from hitloom.plans.common_sql import BEST, LINEAGE, MASKED, covered, lca, rank_of, runs
from hitloom.plans.derive import oracle, view

QUERIES, SQL = {}, {}


def query(sql: str | None = None, views: str = "hits"):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = oracle(views, sql)
        return f

    return add


@query("""SELECT l_orderkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(h, '^@', ''), '[ ]+[12]:[NnYy]:[0-9]+:.*$', ''), '#0/[12]$', ''), '[/._][12]$', '') AS read_id FROM (
 SELECT l_orderkey, concat('@M', CAST(l_orderkey AS STRING), ':', CAST(l_partkey AS STRING), CASE l_linenumber % 4 WHEN 0 THEN '/1' WHEN 1 THEN ' 1:N:0:ACGT' WHEN 2 THEN '#0/2' ELSE '' END) AS h FROM lineitem)""")
def normalize_read_id(spark, d):
    h = spark.read.parquet(f"{d}/lineitem.parquet").selectExpr("l_orderkey", "concat('@M', l_orderkey, ':', l_partkey, CASE l_linenumber % 4 WHEN 0 THEN '/1' WHEN 1 THEN ' 1:N:0:ACGT' WHEN 2 THEN '#0/2' ELSE '' END) AS h")
    return h.select("l_orderkey", T.normalize_read_id(F.col("h")).alias("read_id"))


@query("SELECT hit_id, CASE WHEN qlen = 0 THEN 0 ELSE alnlen::DOUBLE / qlen END AS qcov, (tend - tstart)::DOUBLE / tlen AS tcov FROM hits")
def query_coverage(spark, d):
    return view(spark, d, "hits").select("hit_id", hits.query_coverage().alias("qcov"), hits.target_coverage().alias("tcov"))


@query("SELECT hit_id, sample, CASE WHEN max(f) OVER (PARTITION BY sample, strand) > 1 THEN f / 100 ELSE f END AS fident FROM (SELECT *, CASE WHEN strand = '+' THEN fident * 100 ELSE fident END AS f FROM hits)")
def rescale_identity(spark, d):
    h = view(spark, d, "hits").withColumn("fident", F.when(F.col("strand") == "+", F.col("fident") * 100).otherwise(F.col("fident")))
    return hits.rescale_identity(h).select("hit_id", "sample", "fident")


@query("SELECT hit_id, query, target, fident, alnlen, evalue FROM hits WHERE fident >= 0.92 AND alnlen >= 60 AND evalue <= 0.001 AND alnlen::DOUBLE / qlen >= 0.5")
def filter_hits(spark, d):
    return hits.filter_hits(view(spark, d, "hits"), hits.FilterCriteria(0.92, 60, 1e-3, 0.5)).select("hit_id", "query", "target", "fident", "alnlen", "evalue")


@query("SELECT hit_id, query, target FROM hits WHERE fident >= 0.93 AND alnlen >= 60 AND alnlen::DOUBLE / qlen >= 0.5")
def filter_hits_quality(spark, d):
    return hits.filter_hits_quality(view(spark, d, "hits"), hits.QualityCriteria(0.93, 60, 0.5)).select("hit_id", "query", "target")


@query("SELECT hit_id, target FROM hits WHERE target NOT IN ('T1_0', 'T2_1')")
def drop_contaminants(spark, d):
    return hits.drop_contaminants(view(spark, d, "hits"), ["T1_0", "T2_1"]).select("hit_id", "target")


@query("SELECT h.hit_id, h.taxid FROM hits h JOIN taxonomy t USING (taxid) WHERE taxid NOT IN (3001, 3005) AND NOT contains(lower(name), '007')", "hits taxonomy")
def blacklist(spark, d):
    named = view(spark, d, "hits").join(view(spark, d, "taxonomy").select("taxid", F.col("name").alias("taxname")), "taxid")
    return hits.blacklist(named, [3001, 3005], ["#0000000" + "07", "007"]).select("hit_id", "taxid")


@query("WITH" + MASKED + " SELECT hit_id, target, tstart, tend, is_masked FROM hm", "hits mask")
def label_masked_hits(spark, d):
    return hits.label_masked_hits(view(spark, d, "hits"), view(spark, d, "mask")).select("hit_id", "target", "tstart", "tend", "is_masked")


@query("WITH" + ",".join(MASKED.replace("hm AS", f"h{t} AS").replace("0.5", f"0.{t}") for t in (1, 9)) + " SELECT h1.hit_id, h1.is_masked AS at_10, h9.is_masked AS at_90 FROM h1 JOIN h9 USING (hit_id)", "hits mask")
def label_masked_hits_thresholds(spark, d):
    h, m = view(spark, d, "hits"), view(spark, d, "mask")
    low = hits.label_masked_hits(h, m, 0.1).select("hit_id", F.col("is_masked").alias("at_10"))
    return low.join(hits.label_masked_hits(h, m, 0.9).select("hit_id", F.col("is_masked").alias("at_90")), "hit_id")


@query("WITH" + MASKED + " SELECT hit_id, query FROM hm WHERE NOT is_masked", "hits mask")
def drop_all_masked(spark, d):
    return hits.drop_all_masked_reads(view(spark, d, "hits"), view(spark, d, "mask")).select("hit_id", "query")


@query("WITH" + MASKED + """, r AS (SELECT sample, query, count(*) AS n, sum(is_masked::INT) AS m FROM hm GROUP BY ALL)
 SELECT sample, count(*) AS reads, sum((n = m)::INT)::BIGINT AS all_masked_reads, sum(n)::BIGINT AS hits, sum(m)::BIGINT AS masked_hits FROM r GROUP BY sample""", "hits mask")
def masked_read_summary(spark, d):
    return hits.masked_read_summary(view(spark, d, "hits"), view(spark, d, "mask"))


@query("SELECT h.sample, h.target, count(DISTINCT query) AS masked_reads FROM hits h JOIN mask m ON h.target = m.target AND least(h.tend, m.hi) > greatest(h.tstart, m.lo) WHERE m.lo < m.hi GROUP BY ALL", "hits mask")
def masked_read_count(spark, d):
    return hits.masked_read_count(view(spark, d, "hits"), view(spark, d, "mask"))


@query("SELECT hit_id, target, target IN (SELECT target FROM mask) AS passed FROM hits", "hits mask")
def split_by_target(spark, d):
    yes, no = hits.split_by_target(view(spark, d, "hits"), view(spark, d, "mask"))
    return yes.select("hit_id", "target", F.lit(True).alias("passed")).unionByName(no.select("hit_id", "target", F.lit(False).alias("passed")))


@query("SELECT hit_id FROM hits WHERE taxid IN (SELECT taxid FROM refs UNION SELECT taxid FROM taxonomy WHERE name IS NOT NULL AND taxid % 3 = 0)", "hits refs taxonomy")
def keep_viral(spark, d):
    return hits.keep_viral(view(spark, d, "hits"), view(spark, d, "refs"), view(spark, d, "taxonomy").where("taxid % 3 = 0")).select("hit_id")


@query("SELECT hit_id, sample FROM hits WHERE sample <> 's2'")
def exclude_samples(spark, d):
    return hits.exclude_samples(view(spark, d, "hits"), view(spark, d, "hits").select("sample").where("sample = 's2'")).select("hit_id", "sample")


@query("SELECT hit_id, coalesce(r.taxid, h.taxid) AS working_taxid, coalesce(r.segment_name, h.target) AS segment, coalesce(r.length, h.tlen) AS segment_length FROM hits h LEFT JOIN (SELECT * FROM refs WHERE taxid % 9 <> 0) r ON h.target = r.accession", "hits refs")
def attach_segments(spark, d):
    return hits.attach_segments(view(spark, d, "hits"), view(spark, d, "refs").where("taxid % 9 != 0")).select("hit_id", "working_taxid", "segment", "segment_length")


@query("SELECT target, CAST(floor(floor((tstart + tend) / 2.0) / 100) AS BIGINT) AS win, round(avg(fident), 9) AS identity, count(*) AS n FROM hits GROUP BY 1, 2 HAVING count(*) >= 5")
def identity_windows(spark, d):
    return hits.identity_windows(view(spark, d, "hits")).select("target", F.col("window").alias("win"), F.round("identity", 9).alias("identity"), "n")


@query("WITH" + covered("hits", "sample, target") + " SELECT sample, target, least(1.0, coalesce(covered, 0)::DOUBLE / 2000) AS coverage_ratio FROM cov")
def merged_coverage(spark, d):
    return intervals.merged_coverage_ratio(view(spark, d, "hits"))


@query("WITH ins AS (SELECT sample, target, greatest(tstart, 0) AS tstart, least(tend, tlen) AS tend FROM hits WHERE greatest(tstart, 0) < least(tend, tlen))," + covered("ins", "sample, target") + ", b AS (SELECT sample, target, sum(tend - tstart) AS bases FROM ins GROUP BY ALL) SELECT sample, target, covered::BIGINT AS breadth_bp, bases::DOUBLE / covered AS avg_depth FROM cov JOIN b USING (sample, target)")
def breadth_depth(spark, d):
    return intervals.breadth_depth(view(spark, d, "hits"))


@query("WITH" + runs("hits", "sample, target") + " SELECT sample, target, lo, hi, depth::BIGINT AS depth FROM runs")
def depth_segments(spark, d):
    return intervals.depth_segments(view(spark, d, "hits")).withColumnsRenamed({"start": "lo", "end": "hi"})


@query("WITH" + runs("hits", "sample, target") + """, t AS (SELECT sample, target, sum((hi - lo) * depth) AS t, sum((hi - lo) * depth * ln(depth)) AS u FROM runs GROUP BY ALL)
 SELECT sample, target, round((ln(t) - u / t) / ln(2000), 9) AS depth_entropy FROM t""")
def depth_entropy(spark, d):
    h = view(spark, d, "hits")
    lengths = h.groupBy("sample", "target").agg(F.min("tlen").alias("tlen"))
    return intervals.depth_entropy(intervals.depth_segments(h), lengths).select("sample", "target", F.round("depth_entropy", 9).alias("depth_entropy"))


@query("""WITH o AS (SELECT accession, taxid, coalesce(sum(length) OVER (PARTITION BY taxid ORDER BY accession ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM refs),""" + runs("hits", "sample, target") + " SELECT sample, taxid AS virus, (lo + off)::BIGINT AS lo, (hi + off)::BIGINT AS hi, depth::BIGINT AS depth FROM runs JOIN o ON runs.target = o.accession", "hits refs")
def reference_depth_track(spark, d):
    segments = view(spark, d, "refs").select(F.col("taxid").alias("virus"), F.col("accession").alias("target"), "length")
    return intervals.reference_depth_track(intervals.depth_segments(view(spark, d, "hits")), segments).withColumnsRenamed({"start": "lo", "end": "hi"})


# --- taxonomy


@query("WITH" + LINEAGE + ", sub AS (SELECT taxid, rank, name, 0 AS depth FROM lin WHERE taxid = 102 UNION ALL SELECT t.taxid, t.rank, t.name, s.depth + 1 FROM one_taxon t JOIN sub s ON t.parent_taxid = s.taxid WHERE t.taxid <> t.parent_taxid) SELECT * FROM sub", "taxonomy")
def subtree(spark, d):
    return taxonomy.subtree(taxonomy.lineages(view(spark, d, "taxonomy")), 102)


@query("WITH" + LINEAGE + " SELECT taxid, rank, name, depth, list_aggregate(ids, 'string_agg', '|') AS ids FROM lin", "taxonomy")
def lineage(spark, d):
    return taxonomy.lineages(view(spark, d, "taxonomy")).select("taxid", "rank", "name", "depth", F.array_join(F.col("path")["taxid"].cast("array<string>"), "|").alias("ids"))


@query("WITH" + LINEAGE + "," + rank_of("genus") + " SELECT hit_id, coalesce(a, h.taxid) AS rank_taxid FROM hits h LEFT JOIN up USING (taxid)", "hits taxonomy")
def taxid_at_rank(spark, d):
    return taxonomy.attach_rank(view(spark, d, "hits"), taxonomy.lineages(view(spark, d, "taxonomy")), "genus").select("hit_id", "rank_taxid")


@query("WITH" + LINEAGE + "," + rank_of("species") + " SELECT taxid, a AS rank_taxid FROM taxonomy JOIN up USING (taxid)", "taxonomy")
def rank_strict(spark, d):
    t = view(spark, d, "taxonomy")
    return taxonomy.attach_rank_strict(t, taxonomy.lineages(t), "species").select("taxid", "rank_taxid")


@query("WITH" + LINEAGE + " SELECT hit_id, lin.name, lin.rank, CASE lin.rank WHEN 'species' THEN 'S' WHEN 'strain' THEN 'S1' END AS rank_code, list_aggregate(ids, 'string_agg', '|') AS lineage FROM hits JOIN lin USING (taxid)", "hits taxonomy")
def attach_taxon(spark, d):
    return taxonomy.attach_taxon(view(spark, d, "hits"), taxonomy.lineages(view(spark, d, "taxonomy"))).select("hit_id", "name", "rank", "rank_code", "lineage")


@query("WITH" + LINEAGE + "," + lca("hits", "sample, query") + " SELECT sample, query, lca_taxid, n_taxids::INT AS n_taxids FROM lca", "hits taxonomy")
def lca_reads(spark, d):
    return taxonomy.lca_of_sets(view(spark, d, "hits").select("sample", "query", "taxid"), taxonomy.lineages(view(spark, d, "taxonomy")), ("sample", "query"))


@query("WITH" + LINEAGE + ", m AS (SELECT taxid, max(d) AS own FROM anc GROUP BY taxid) SELECT l.taxid, l.rank, (SELECT arg_max(a, d) FROM anc WHERE anc.taxid = l.taxid AND d < l.depth AND ar IN ('family', 'genus', 'species')) AS parent_taxid FROM lin l WHERE rank IN ('family', 'genus', 'species')", "taxonomy")
def major_tree(spark, d):
    return taxonomy.major_tree(taxonomy.lineages(view(spark, d, "taxonomy")))


@query("WITH" + LINEAGE + " SELECT s.taxid, 200 + s.taxid % 25 AS ancestor, EXISTS (SELECT 1 FROM anc WHERE anc.taxid = s.taxid AND a = 200 + s.taxid % 25) AS is_ancestor FROM taxonomy s WHERE rank = 'species'", "taxonomy")
def is_ancestor(spark, d):
    t = view(spark, d, "taxonomy")
    return taxonomy.is_ancestor(t.where("rank = 'species'").selectExpr("taxid", "200 + taxid % 25 AS ancestor"), taxonomy.lineages(t))


@query("SELECT taxid, name, rank FROM taxonomy WHERE contains(lower(name), 'nation_1')", "taxonomy")
def search_names(spark, d):
    return taxonomy.search_names(view(spark, d, "taxonomy"), "NATION_1").select("taxid", "name", "rank")


@query("SELECT count(*) AS taxa, bool_or(taxid = 1) AS has_root, bool_or(taxid = 10239) AS has_viruses, count(*) FILTER (name IS NULL) AS unnamed, count(*) FILTER (parent_taxid NOT IN (SELECT taxid FROM taxonomy)) AS orphans FROM taxonomy", "taxonomy")
def verify_taxonomy(spark, d):
    return taxonomy.verify_taxonomy(view(spark, d, "taxonomy"))


@query("WITH" + LINEAGE + "," + rank_of("species") + " SELECT accession, coalesce(segment_name, accession) AS segment, length, coalesce(a, r.taxid) AS species_taxid, is_segmented FROM refs r LEFT JOIN up USING (taxid)", "refs taxonomy")
def segment_info(spark, d):
    return taxonomy.segment_info(view(spark, d, "refs"), taxonomy.lineages(view(spark, d, "taxonomy")))


@query("WITH" + LINEAGE + "," + rank_of("genus") + """, v AS (SELECT sample, a AS rank_taxid, sum(reads)::BIGINT AS value FROM counts JOIN up USING (taxid) WHERE taxid IN (SELECT taxid FROM anc WHERE a = 101) GROUP BY ALL)
 SELECT sample, rank_taxid, list_aggregate(names, 'string_agg', ';') AS lineage, value, value::DOUBLE / sum(value) OVER (PARTITION BY sample) AS proportion FROM v JOIN lin ON lin.taxid = v.rank_taxid""", "counts taxonomy")
def descendants_at_rank(spark, d):
    return taxonomy.descendants_at_rank(view(spark, d, "counts").withColumnRenamed("reads", "value"), taxonomy.lineages(view(spark, d, "taxonomy")), "genus", 101)


@query("SELECT hit_id, CASE taxid WHEN 1 THEN 'x' END AS none, lower(trim(r)) AS rank, lv AS level FROM (SELECT hit_id, taxid, CASE WHEN taxid >= 100000 THEN ' Strain' ELSE 'SPECIES' END AS r, CASE WHEN taxid >= 100000 THEN 15 ELSE 13 END AS lv FROM hits)")
def rank_functions(spark, d):
    r = F.when(F.col("taxid") >= 100000, " Strain").otherwise("SPECIES")
    return view(spark, d, "hits").select("hit_id", F.lit(None).cast("string").alias("none"), T.normalize_rank(r).alias("rank"), T.rank_level(r).alias("level"))


# --- assignment


@query("WITH" + BEST + " SELECT sample, query, taxid, bits, fident, n_hits, n_unique_taxids FROM best")
def best_hit(spark, d):
    return assign.best_hit(view(spark, d, "hits"))


@query("WITH" + BEST + "," + LINEAGE + "," + rank_of("species") + " SELECT sample, query, coalesce(a, b.taxid) AS lca_taxid, l.name AS lca_name, l.rank AS lca_rank, 1 AS read_count, n_hits, n_unique_taxids FROM best b LEFT JOIN up USING (taxid) LEFT JOIN lin l ON l.taxid = coalesce(a, b.taxid)", "hits taxonomy")
def classify_best_hit(spark, d):
    return assign.classify_best_hit(view(spark, d, "hits"), taxonomy.lineages(view(spark, d, "taxonomy")), "species")


CANDS = "cands AS (SELECT sample, query, taxid, max(bits) AS best_score, max(fident) AS best_identity, count(*) OVER (PARTITION BY sample, query) AS candidate_count FROM hits GROUP BY sample, query, taxid), firsts AS (SELECT *, row_number() OVER (PARTITION BY sample, query ORDER BY best_score DESC, best_identity DESC, taxid) AS k FROM cands)"


@query(f"WITH {CANDS} SELECT * FROM cands")
def candidates(spark, d):
    return assign.candidates(view(spark, d, "hits"), "taxid")


@query(f"WITH {CANDS} SELECT hit_id, h.taxid FROM hits h JOIN firsts f ON h.sample = f.sample AND h.query = f.query AND h.taxid = f.taxid WHERE k = 1")
def resolve_multi_best(spark, d):
    return assign.resolve_multi_best(view(spark, d, "hits"), "taxid").select("hit_id", "taxid")


@query(f"WITH {CANDS}, r AS (SELECT *, row_number() OVER (PARTITION BY sample, query ORDER BY best_score DESC, best_identity DESC, taxid) AS j FROM cands WHERE taxid % 3 <> 1) SELECT sample, query, taxid, best_score, best_identity, candidate_count, CASE WHEN candidate_count = 1 THEN 'unique' ELSE 'multi' END AS map_type FROM r WHERE j = 1")
def assign_reads(spark, d):
    h = view(spark, d, "hits")
    return assign.assign_reads(assign.candidates(h, "taxid"), h.where("taxid % 3 != 1"), "taxid")


_LCA_ALL = "WITH" + LINEAGE + "," + lca("hits", "sample, query")


@query(_LCA_ALL + ", c AS (SELECT sample, query, count(*) AS n_hits, max(qlen) AS qlen, count(DISTINCT taxid) AS n_unique_taxids, list_aggregate(list_sort(list(DISTINCT taxid)), 'string_agg', ',') AS all_taxids FROM hits GROUP BY ALL) SELECT c.sample, c.query, lca_taxid, l.name AS lca_name, l.rank AS lca_rank, qlen, 1 AS read_count, n_hits, n_unique_taxids, all_taxids FROM c LEFT JOIN lca USING (sample, query) LEFT JOIN lin l ON l.taxid = lca_taxid", "hits taxonomy")
def classify_lca(spark, d):
    rows = assign.classify_lca(view(spark, d, "hits"), taxonomy.lineages(view(spark, d, "taxonomy")))
    return rows.withColumn("all_taxids", F.array_join(F.col("all_taxids").cast("array<string>"), ","))


@query(_LCA_ALL + "," + rank_of("genus") + """, r AS (SELECT sample, query, lca_taxid, l.rank AS lca_rank, coalesce(a, lca_taxid) AS genus FROM lca JOIN lin l ON l.taxid = lca_taxid LEFT JOIN up ON up.taxid = lca_taxid),
 g AS (SELECT sample, genus, count(*) AS g FROM r GROUP BY ALL), s AS (SELECT sample, lca_taxid, count(*) AS s FROM r WHERE lca_rank = 'species' GROUP BY ALL)
 SELECT sample, query, CASE WHEN lca_rank = 'species' AND s::DOUBLE / g < 0.3 THEN genus ELSE lca_taxid END AS lca_taxid, coalesce(lca_rank = 'species' AND s::DOUBLE / g < 0.3, false) AS moved
 FROM r LEFT JOIN g USING (sample, genus) LEFT JOIN s USING (sample, lca_taxid)""", "hits taxonomy")
def lca_conditional(spark, d):
    lin = taxonomy.lineages(view(spark, d, "taxonomy"))
    return assign.classify_lca_conditional(assign.classify_lca(view(spark, d, "hits"), lin), lin, 0.3)


_PER = "per AS (SELECT *, max(top) OVER (PARTITION BY sample, query, strand) AS best FROM (SELECT sample, query, strand, taxid, max(bits) AS top, sum(bits) AS total FROM hits GROUP BY ALL)), mates AS (SELECT sample, query, count(DISTINCT strand) AS mates FROM hits GROUP BY ALL)"
_TAXA = "taxa AS (SELECT sample, query, taxid, count(DISTINCT strand) AS m FROM per WHERE top >= best - {t} GROUP BY ALL)"


def _paired(name, sql):
    def f(spark, d):
        return assign.paired_concordance(view(spark, d, "hits"), taxonomy.lineages(view(spark, d, "taxonomy")), name)

    f.__name__ = "paired_" + name.split("_")[1]
    query("WITH" + LINEAGE + f", {_PER}, {sql}," + lca("chosen", "sample, query") + " SELECT * FROM lca", "hits taxonomy")(f)


_paired("pe_strict", _TAXA.format(t=5) + ", chosen AS (SELECT sample, query, taxid FROM taxa JOIN mates USING (sample, query) WHERE mates = 1 OR m = 2)")
_paired("pe_coord", _TAXA.format(t=10) + ", chosen AS (SELECT sample, query, taxid FROM (SELECT *, max(m) OVER (PARTITION BY sample, query) AS mm FROM taxa JOIN mates USING (sample, query)) WHERE mates = 1 OR m = 2 OR mm < 2)")
_paired("pe_balanced", _TAXA.format(t=10) + ", w AS (SELECT *, max(w) OVER (PARTITION BY sample, query) AS tw FROM (SELECT sample, query, taxid, sum(total) AS w FROM per GROUP BY ALL)), chosen AS (SELECT sample, query, taxid FROM w JOIN mates USING (sample, query) WHERE mates = 2 AND tw - w < 10 UNION ALL SELECT sample, query, taxid FROM taxa JOIN mates USING (sample, query) WHERE mates = 1)")


@query("WITH" + LINEAGE + "," + rank_of("species") + """, r AS (SELECT sample, query, coalesce(a, h.taxid) AS taxon, count(DISTINCT strand) AS m FROM hits h LEFT JOIN up USING (taxid) GROUP BY ALL)
 SELECT sample, taxon, count(*) AS reads, count(*) FILTER (m >= 2) AS both_mate_reads, count(*) FILTER (m >= 2)::DOUBLE / count(*) AS both_frac FROM r GROUP BY ALL""", "hits taxonomy")
def pair_support(spark, d):
    return assign.pair_support(view(spark, d, "hits"), taxonomy.lineages(view(spark, d, "taxonomy")))


@query("WITH" + LINEAGE + "," + rank_of("genus") + ", u AS (SELECT sample, taxid, count(*) AS unique_reads FROM hits GROUP BY ALL) SELECT sample, u.taxid, unique_reads, unique_reads < 0.9 * max(unique_reads) OVER (PARTITION BY sample, coalesce(a, u.taxid)) AS demoted FROM u LEFT JOIN up USING (taxid)", "hits taxonomy")
def genus_competition(spark, d):
    u = view(spark, d, "hits").groupBy("sample", "taxid").agg(F.count("*").alias("unique_reads"))
    return assign.genus_competition(u, taxonomy.lineages(view(spark, d, "taxonomy")), 0.9)


@query("WITH" + runs("hits", "sample, target") + """, md AS (SELECT sample, target, sum((hi - lo) * depth)::DOUBLE / sum(hi - lo) AS mean_depth FROM runs GROUP BY ALL),
 h AS (SELECT hit_id, any_value(x.sample) AS sample, any_value(query) AS query, any_value(x.target) AS target, any_value(bits) AS bits, sum((least(tend, hi) - greatest(tstart, lo)) * depth)::DOUBLE / sum(least(tend, hi) - greatest(tstart, lo)) AS local_depth
   FROM hits x JOIN runs r ON x.sample = r.sample AND x.target = r.target AND lo < tend AND hi > tstart GROUP BY hit_id),
 e AS (SELECT hit_id, h.sample, query, h.target, local_depth, exp(bits / 100 - abs(local_depth - mean_depth) / mean_depth) AS e FROM h JOIN md USING (sample, target))
 SELECT hit_id, sample, query, target, round(local_depth, 9) AS local_depth, round(e / sum(e) OVER (PARTITION BY sample, query), 9) AS weight FROM e""")
def local_depth_weights(spark, d):
    rows = assign.local_depth_weights(view(spark, d, "hits"))  # rows of one hit_id are of one read
    return rows.withColumns({"local_depth": F.round("local_depth", 9), "weight": F.round("weight", 9)})


# --- masks


@query("SELECT query, hit, alen, pid, strand, least(qf, qt) AS qf, greatest(qf, qt) AS qt, least(hf, ht) AS hf, greatest(hf, ht) AS ht FROM hsps WHERE alen >= 150 AND pid >= 90", "hsps")
def hsp_filter(spark, d):
    return mask.hsp_filter(view(spark, d, "hsps")).select("query", "hit", "alen", "pid", "strand", "qf", "qt", "hf", "ht")


_IV = "iv AS (SELECT query AS acc, hit AS other, least(qf, qt) - 1 AS tstart, greatest(qf, qt) AS tend FROM hsps WHERE alen >= 150 AND pid >= 90)"


def islands_sql(source: str, by: str, lo: str, hi: str, gap: int = 0, out: str = "isl") -> str:
    """Equal intervals are of one island, whichever of them is the first to be seen."""
    return f"""
{out}_m AS (SELECT *, max({hi}) OVER (PARTITION BY {by} ORDER BY {lo}, {hi} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM {source} WHERE {lo} < {hi}),
{out}_n AS (SELECT *, sum(CASE WHEN p IS NULL OR {lo} > p + {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY {by} ORDER BY {lo}, {hi} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS i FROM {out}_m),
{out} AS (SELECT {by}, min({lo}) AS lo, max({hi}) AS hi, count(*) AS n FROM {out}_n GROUP BY {by}, i)"""


@query(f"WITH {_IV}," + islands_sql("iv", "acc, other", "tstart", "tend") + ", dep AS (SELECT acc, other, sum(tend - tstart) AS b FROM iv GROUP BY ALL) SELECT i.acc, i.other, i.lo, i.hi, i.n, (SELECT sum(v.tend - v.tstart) FROM iv v WHERE v.acc = i.acc AND v.other = i.other AND v.tstart >= i.lo AND v.tend <= i.hi)::DOUBLE / (i.hi - i.lo) AS mean_depth FROM isl i", "hsps")
def merge_with_depth(spark, d):
    iv = mask.hsp_to_intervals(mask.hsp_filter(view(spark, d, "hsps")))
    return mask.merge_with_depth(iv).withColumnsRenamed({"start": "lo", "end": "hi"})


@query(f"WITH {_IV}, b AS (SELECT DISTINCT acc, other, tstart, tend, 'q' AS src FROM iv)," + islands_sql("b", "acc, src", "tstart", "tend", 30) + " SELECT acc, src AS source, lo, hi, n FROM isl", "hsps")
def assemble_mask(spark, d):
    iv = mask.hsp_to_intervals(mask.hsp_filter(view(spark, d, "hsps"))).select("acc", "other", "start", "end", F.lit("q").alias("source")).distinct()
    # two partners' equal regions stay two rows of one source here, so they're told apart by other before assembling
    from hitloom.operators.intervals import islands

    return islands(iv, ("acc", "source"), 30).withColumnsRenamed({"start": "lo", "end": "hi"})


@query("WITH b AS (SELECT target AS acc, lo, hi, CAST(hi - lo AS STRING) AS depth, concat('p', CAST(lo AS STRING)) AS other FROM mask WHERE lo < hi)," + islands_sql("b", "acc", "lo", "hi") + " SELECT i.acc, 'x' AS descr, i.lo, i.hi, string_agg(b.depth, ';' ORDER BY b.lo, b.hi, b.other, b.depth) AS depths, string_agg(b.other, ';' ORDER BY b.lo, b.hi, b.other, b.depth) AS others FROM isl i JOIN b ON b.acc = i.acc AND b.lo >= i.lo AND b.hi <= i.hi GROUP BY i.acc, i.lo, i.hi", "mask")
def mask_merge(spark, d):
    b = view(spark, d, "mask").selectExpr("target AS acc", "'x' AS desc", "start", "end", "CAST(end - start AS STRING) AS depth", "concat('p', start) AS other")
    return mask.merge_bed(b.where("start < end")).withColumnsRenamed({"start": "lo", "end": "hi", "desc": "descr"})


@query("SELECT accession AS acc, 0 AS lo, length AS hi, 'partial_cds' AS source FROM refs WHERE contains(lower(title), 'partial')", "refs")
def partial_cds_mask(spark, d):
    r = view(spark, d, "refs").selectExpr("accession AS acc", "replace(title, 'partial', 'Partial CDS') AS desc", "length")
    return mask.partial_cds_mask(r).withColumnsRenamed({"start": "lo", "end": "hi"})


@query("WITH" + covered("mask", "target", "cov", "lo", "hi") + ", s AS (SELECT taxid % 10 AS family, coalesce(covered, 0)::DOUBLE / length AS share FROM refs LEFT JOIN cov ON accession = target) SELECT family, count(*) AS accessions, round(avg(share), 9) AS mean_share, quantile_cont(share, 0.5) AS median_share, sum((share > 0.5)::INT)::BIGINT AS over FROM s GROUP BY family", "mask refs")
def mask_fraction_report(spark, d):
    m = view(spark, d, "mask").withColumnRenamed("target", "acc")
    r = view(spark, d, "refs").selectExpr("accession AS acc", "taxid % 10 AS family", "length")
    return mask.mask_fraction_report(m, r, 0.5).withColumn("mean_share", F.round("mean_share", 9))


@query("SELECT query AS cluster, quantile_cont(pid, 0.5) AS median_pid, count(*) AS n FROM hsps GROUP BY 1 HAVING quantile_cont(pid, 0.5) >= 90", "hsps")
def cluster_median_identity(spark, d):
    return mask.cluster_median_identity(view(spark, d, "hsps").select(F.col("query").alias("cluster"), "pid"), 90.0)


@query("SELECT hit, count(*) AS n, quantile_cont(alen, 0.5) AS median_length, quantile_cont(pid, 0.5) AS median_identity, avg((strand = '+')::INT) AS plus_share, min(qf) AS window_start, max(qt) AS window_end FROM hsps GROUP BY hit", "hsps")
def hsp_summary(spark, d):
    return mask.hsp_summary(view(spark, d, "hsps"))
