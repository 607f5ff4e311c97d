"""Queries on coverage, judgement, abundance, counts and hosts, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.functions.stage import stage
from hitloom.operators import assign, counts, coverage, hits, host, taxonomy
from hitloom.plans.common_sql import BEST, LINEAGE, MASKED, covered, lca, rank_of
from hitloom.plans import pipelines
from hitloom.plans.derive import oracle, view

QUERIES, SQL = {}, {}


def query(sql: str | None = None, views: str = "hits"):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = oracle(views, sql)
        return f

    return add


def lin(spark, d) -> DataFrame:
    return taxonomy.lineages(view(spark, d, "taxonomy"))


STATS = (
    "WITH" + MASKED + """,
kinds AS (SELECT *, 'total' AS kind FROM hm UNION ALL SELECT *, CASE WHEN is_masked THEN 'masked' ELSE 'unmasked' END FROM hm),
inside AS (SELECT sample, target, kind, greatest(tstart, 0) AS tstart, least(tend, tlen) AS tend FROM kinds WHERE greatest(tstart, 0) < least(tend, tlen)),"""
    + covered("kinds", "sample, target, kind") + "," + covered("inside", "sample, target, kind", "cin") + """,
b AS (SELECT sample, target, kind, sum(tend - tstart) AS bases FROM inside GROUP BY ALL),
k AS (SELECT sample, target, kind, count(*) AS hit_count, any_value(tlen) AS tlen FROM kinds GROUP BY ALL),
one AS (SELECT k.*, cin.covered AS breadth_bp, least(1.0, coalesce(cov.covered, 0)::DOUBLE / tlen) AS coverage_ratio, b.bases::DOUBLE / cin.covered AS avg_depth
  FROM k LEFT JOIN cov USING (sample, target, kind) LEFT JOIN cin USING (sample, target, kind) LEFT JOIN b USING (sample, target, kind)),
stats AS (SELECT sample, target, """
    + ", ".join(f"coalesce(max(CASE WHEN kind = '{k}' THEN {c} END), 0){'::BIGINT' if c in ('hit_count', 'breadth_bp') else ''} AS {k}_{c}" for k in ("total", "masked", "unmasked") for c in ("hit_count", "breadth_bp", "coverage_ratio", "avg_depth"))
    + ", target IN (SELECT target FROM mask WHERE lo < hi) AS has_mask FROM one GROUP BY sample, target)"
)


@query(STATS + " SELECT * FROM stats", "hits mask")
def coverage_stats(spark, d):
    return coverage.coverage_stats(view(spark, d, "hits"), view(spark, d, "mask"))


def _gate(name, condition, **limits):
    def f(spark, d):
        return coverage.filter_by_coverage(view(spark, d, "hits"), view(spark, d, "mask"), **limits).select("hit_id", "sample", "target")

    f.__name__ = name
    query(STATS + f" SELECT hit_id, h.sample, h.target FROM hits h JOIN stats s ON h.sample = s.sample AND h.target = s.target WHERE {condition}", "hits mask")(f)


_gate("filter_unmasked", "unmasked_coverage_ratio >= 0.3", unmasked=0.3)
_gate("filter_total", "total_coverage_ratio >= 0.5", total=0.5)


@query(STATS + " SELECT sample, target, unmasked_coverage_ratio >= 0.3 AS passed_unmasked, total_coverage_ratio >= 0.4 AS passed_total, unmasked_coverage_ratio >= 0.3 AND total_coverage_ratio >= 0.4 AS passed, CASE WHEN unmasked_coverage_ratio >= 0.3 AND total_coverage_ratio >= 0.4 THEN 'both' WHEN unmasked_coverage_ratio >= 0.3 THEN 'unmasked_only' WHEN total_coverage_ratio >= 0.4 THEN 'total_only' ELSE 'neither' END AS outcome FROM stats", "hits mask")
def filter_hybrid(spark, d):
    stats = coverage.coverage_stats(view(spark, d, "hits"), view(spark, d, "mask"))
    return coverage.passing_targets(stats, 0.3, 0.4).select("sample", "target", "passed_unmasked", "passed_total", "passed", "outcome")


@query(STATS + ", j AS (SELECT *, (total_coverage_ratio >= 0.4)::INT AS p FROM stats) SELECT sample, sum(p)::BIGINT AS passed_targets, sum(1 - p)::BIGINT AS failed_targets, sum(p * total_hit_count)::BIGINT AS passed_hits, sum((1 - p) * total_hit_count)::BIGINT AS failed_hits, round(avg(total_coverage_ratio), 9) AS mean_coverage FROM j GROUP BY sample", "hits mask")
def filter_summary(spark, d):
    stats = coverage.coverage_stats(view(spark, d, "hits"), view(spark, d, "mask"))
    return coverage.filter_summary(coverage.passing_targets(stats, total=0.4)).withColumn("mean_coverage", F.round("mean_coverage", 9))


# --- method_b: best hit of all -> unmasked breadth of the best hits -> count


_METHOD_B = "WITH hb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample, query ORDER BY bits DESC, fident DESC, taxid, target DESC, tstart DESC, tend DESC) AS k FROM hits) WHERE k = 1)," + MASKED.replace("FROM hits h", "FROM hb h") + ", u AS (SELECT * FROM hm WHERE NOT is_masked)," + covered("u", "sample, target")


@query(_METHOD_B + " SELECT sample, taxid, count(*) AS read_count FROM hb JOIN cov USING (sample, target) WHERE covered >= 0.01 * 2000 GROUP BY ALL HAVING count(*) >= 3", "hits mask")
def method_b(spark, d):
    return pipelines.method_b(view(spark, d, "hits"), view(spark, d, "mask"))


# --- segment, strain and taxon coverage, and the whole coverage pipeline, resolved by best taxon


def prepared(spark, d):
    """Hits with working taxon, segment and uniqueness, multi-mapped reads reduced to their best taxon."""
    h = hits.attach_segments(view(spark, d, "hits"), view(spark, d, "refs")).select(*coverage.USED)
    cands = stage(assign.candidates(h))
    return stage(h.join(assign.best_taxon(cands), ["sample", "query", "working_taxid"])), cands


PREP = """
seg AS (SELECT h.*, coalesce(r.taxid, h.taxid) AS working_taxid, coalesce(r.segment_name, h.target) AS segment, coalesce(r.length, h.tlen) AS segment_length FROM hits h LEFT JOIN refs r ON h.target = r.accession),
cands AS (SELECT sample, query, working_taxid, max(bits) AS best_score, max(fident) AS best_identity, count(*) OVER (PARTITION BY sample, query) AS candidate_count FROM seg GROUP BY sample, query, working_taxid),
firsts AS (SELECT *, row_number() OVER (PARTITION BY sample, query ORDER BY best_score DESC, best_identity DESC, working_taxid) AS k FROM cands),
prep AS (SELECT s.*, f.candidate_count = 1 AS is_unique FROM seg s JOIN firsts f ON s.sample = f.sample AND s.query = f.query AND s.working_taxid = f.working_taxid WHERE k = 1)"""


def segments_sql(keep: bool) -> str:
    key = "sample, working_taxid, segment"
    full = key + ", target"
    seen = "true" if keep else "m = 0"
    masked = "m > 0" if keep else "false"
    return f"""
ins AS (SELECT {full}, greatest(tstart, 0) AS s, least(tend, segment_length) AS e, is_unique::INT AS u FROM prep WHERE greatest(tstart, 0) < least(tend, segment_length)),
ev AS (SELECT {full}, s AS pos, 1 AS d, u AS du, 0 AS m FROM ins UNION ALL SELECT {full}, e, -1, -u, 0 FROM ins
  UNION ALL SELECT k.sample, k.working_taxid, k.segment, k.target, lo, 0, 0, 1 FROM mask JOIN (SELECT DISTINCT {full} FROM ins) k ON k.target = mask.target WHERE lo < hi
  UNION ALL SELECT k.sample, k.working_taxid, k.segment, k.target, hi, 0, 0, -1 FROM mask JOIN (SELECT DISTINCT {full} FROM ins) k ON k.target = mask.target WHERE lo < hi),
st AS (SELECT {full}, pos, sum(d) AS d, sum(du) AS du, sum(m) AS m FROM ev GROUP BY ALL),
rn AS (SELECT {full}, pos, lead(pos) OVER w - pos AS n, sum(d) OVER w AS d, sum(du) OVER w AS du, sum(m) OVER w AS m FROM st WINDOW w AS (PARTITION BY {full} ORDER BY pos)),
cv AS (SELECT {key}, sum(CASE WHEN {seen} THEN n ELSE 0 END) AS breadth_bp, sum(CASE WHEN {seen} AND du > 0 THEN n ELSE 0 END) AS unique_breadth_bp, sum(CASE WHEN {seen} AND du < d THEN n ELSE 0 END) AS multi_breadth_bp,
  sum(CASE WHEN {masked} THEN n ELSE 0 END) AS masked_breadth_bp, sum(CASE WHEN {seen} THEN n * d ELSE 0 END) AS ds, sum(CASE WHEN {seen} THEN n * d * ln(d) ELSE 0 END) AS dl FROM rn WHERE n IS NOT NULL AND d > 0 GROUP BY {key}),
sz AS (SELECT {key}, floor(sum(segment_length) / count(*))::BIGINT AS length, count(*) AS hits FROM prep GROUP BY {key}),
mk AS (SELECT DISTINCT p.sample, p.working_taxid, p.segment, p.target, greatest(lo, 0) AS ml, least(hi, p.segment_length) AS mh FROM prep p JOIN mask ON mask.target = p.target),
{covered("mk", full, "mc", "ml", "mh")},
mb AS (SELECT {key}, sum(covered) AS mask_bp FROM mc GROUP BY {key}),
segs AS (SELECT sz.*, coalesce(breadth_bp, 0)::BIGINT AS breadth_bp, coalesce(unique_breadth_bp, 0)::BIGINT AS unique_breadth_bp, coalesce(multi_breadth_bp, 0)::BIGINT AS multi_breadth_bp, coalesce(masked_breadth_bp, 0)::BIGINT AS masked_breadth_bp,
  coalesce(ds, 0)::DOUBLE / CASE WHEN length - {'0' if keep else 'coalesce(mask_bp, 0)'} > 0 THEN length - {'0' if keep else 'coalesce(mask_bp, 0)'} ELSE length END AS avg_depth,
  CASE WHEN coalesce(ds, 0) = 0 OR length <= 1 THEN 0.0 ELSE (ln(ds) - dl / ds) / ln(length) END AS depth_entropy
  FROM sz LEFT JOIN cv USING ({key}) LEFT JOIN mb USING ({key}))"""


def _segment_query(name: str, keep: bool):
    def f(spark, d):
        rows = coverage.segment_coverage(prepared(spark, d)[0], view(spark, d, "mask"), keep)
        return rows.withColumns({"depth_entropy": F.round("depth_entropy", 9), "avg_depth": F.round("avg_depth", 9)})

    f.__name__ = name
    query(f"WITH {PREP},{segments_sql(keep)} SELECT * REPLACE (round(depth_entropy, 9) AS depth_entropy, round(avg_depth, 9) AS avg_depth) FROM segs", "hits mask refs")(f)


_segment_query("segment_coverage", False)
_segment_query("segment_coverage_with_masked_depth", True)

EXPECTED = "own AS (SELECT taxid, max(expected_genome_length) AS x FROM refs WHERE expected_genome_length IS NOT NULL GROUP BY taxid), expd AS (SELECT taxid, max(x) AS expected_length FROM (SELECT * FROM own UNION ALL SELECT coalesce(a, own.taxid), x FROM own LEFT JOIN up USING (taxid)) GROUP BY taxid)"
STRAINS = f"""
{EXPECTED},
rd AS (SELECT sample, working_taxid, count(DISTINCT query) AS total_reads, count(DISTINCT CASE WHEN is_unique THEN query END) AS unique_reads, count(DISTINCT CASE WHEN NOT is_unique THEN query END) AS multi_reads FROM prep GROUP BY ALL),
mr AS (SELECT p.sample, working_taxid, count(DISTINCT query) AS masked_reads FROM prep p JOIN mask m ON p.target = m.target AND least(p.tend, m.hi) > greatest(p.tstart, m.lo) WHERE m.lo < m.hi GROUP BY ALL),
wt AS (SELECT taxid AS working_taxid, count(DISTINCT coalesce(segment_name, accession)) AS expected_segments FROM refs GROUP BY taxid),
sm AS (SELECT sample, working_taxid, sum(length) AS aligned, sum(breadth_bp) AS b, sum(masked_breadth_bp) AS mb, sum(unique_breadth_bp)::BIGINT AS unique_breadth_bp, sum(multi_breadth_bp)::BIGINT AS multi_breadth_bp,
  sum((breadth_bp::DOUBLE / length >= 0 OR breadth_bp >= 200)::INT)::BIGINT AS segments_detected, max(depth_entropy) AS best_entropy, avg(depth_entropy) AS avg_entropy, min(depth_entropy) AS min_entropy FROM segs GROUP BY ALL),
strains AS (SELECT sample, working_taxid, g AS genome_length, b::DOUBLE / g AS weighted_breadth, (b - mb)::DOUBLE / g AS unmasked_weighted_breadth, total_reads, unique_reads, multi_reads, coalesce(masked_reads, 0) AS masked_reads,
  segments_detected, coalesce(expected_segments, 1) AS expected_segments, unique_breadth_bp, multi_breadth_bp, best_entropy, avg_entropy, min_entropy
  FROM (SELECT *, CASE WHEN coalesce(expected_length >= aligned, false) THEN expected_length ELSE aligned END::BIGINT AS g FROM sm JOIN rd USING (sample, working_taxid) LEFT JOIN mr USING (sample, working_taxid) LEFT JOIN wt USING (working_taxid) LEFT JOIN expd ON expd.taxid = working_taxid))"""
_ALL = f"WITH {LINEAGE},{rank_of('species')},{PREP},{segments_sql(False)},{STRAINS}"


def strains_of(spark, d, denominator="expected"):
    rows, cands = prepared(spark, d)
    m, r = view(spark, d, "mask"), view(spark, d, "refs")
    segments = coverage.segment_coverage(rows, m)
    return coverage.strain_coverage(rows, segments, m, r, coverage.expected_genome_length(r, lin(spark, d)), denominator=denominator), cands


def rounded(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({n: F.round(n, 9) for n in names})


@query(f"WITH {LINEAGE},{rank_of('species')},{EXPECTED} SELECT taxid, expected_length FROM expd", "refs taxonomy")
def expected_genome_length(spark, d):
    return coverage.expected_genome_length(view(spark, d, "refs"), lin(spark, d))


@query(_ALL + " SELECT * REPLACE (round(weighted_breadth, 9) AS weighted_breadth, round(unmasked_weighted_breadth, 9) AS unmasked_weighted_breadth, round(best_entropy, 9) AS best_entropy, round(avg_entropy, 9) AS avg_entropy, round(min_entropy, 9) AS min_entropy) FROM strains", "hits mask refs taxonomy")
def strain_coverage(spark, d):
    return rounded(strains_of(spark, d)[0], "weighted_breadth", "unmasked_weighted_breadth", "best_entropy", "avg_entropy", "min_entropy")


_GENUS = f", upg AS (SELECT taxid, arg_max(a, d) AS g FROM anc WHERE ar = 'genus' GROUP BY taxid)"


@query(_ALL + _GENUS + " SELECT sample, coalesce(g, working_taxid) AS taxon, avg(genome_length) AS avg_genome_length, round(avg(weighted_breadth), 9) AS weighted_breadth, round(avg(unmasked_weighted_breadth), 9) AS unmasked_weighted_breadth, count(*) AS strain_count FROM strains LEFT JOIN upg ON upg.taxid = working_taxid GROUP BY ALL", "hits mask refs taxonomy")
def taxon_coverage(spark, d):
    to = taxonomy.attach_rank(lin(spark, d).select("taxid"), lin(spark, d), "genus", out="taxon").withColumnRenamed("taxid", "working_taxid")
    return rounded(coverage.taxon_coverage(strains_of(spark, d)[0], to), "weighted_breadth", "unmasked_weighted_breadth")


SUMMARY = """
summ AS (SELECT sample, working_taxid AS taxon, count(*) AS strain_count, avg(genome_length) AS avg_genome_length, avg(weighted_breadth) AS weighted_breadth, avg(unmasked_weighted_breadth) AS unmasked_weighted_breadth,
  sum(total_reads)::BIGINT AS total_reads, sum(unique_reads)::BIGINT AS unique_reads, sum(multi_reads)::BIGINT AS multi_reads, sum(masked_reads)::BIGINT AS masked_reads, sum(segments_detected)::BIGINT AS segments_detected,
  sum(expected_segments)::BIGINT AS expected_segments, sum(unique_breadth_bp)::BIGINT AS unique_breadth_bp, sum(multi_breadth_bp)::BIGINT AS multi_breadth_bp, max(best_entropy) AS best_entropy, avg(avg_entropy) AS avg_entropy,
  min(min_entropy) AS min_entropy, max((segments_detected >= greatest(1, floor(expected_segments * 0.1)))::INT) AS segment_ok FROM strains GROUP BY ALL)"""
_R = "round(weighted_breadth, 9) AS weighted_breadth, round(unmasked_weighted_breadth, 9) AS unmasked_weighted_breadth, round(best_entropy, 9) AS best_entropy, round(avg_entropy, 9) AS avg_entropy, round(min_entropy, 9) AS min_entropy"
_RN = ("weighted_breadth", "unmasked_weighted_breadth", "best_entropy", "avg_entropy", "min_entropy")


@query(_ALL + "," + SUMMARY + f" SELECT * REPLACE ({_R}) FROM summ", "hits mask refs taxonomy")
def coverage_summary(spark, d):
    return rounded(coverage.coverage_summary(strains_of(spark, d)[0]), *_RN)


REAL = "real AS (SELECT *, weighted_breadth >= 0.01 AND segment_ok = 1 AND unique_reads + multi_reads >= 10 AND unmasked_weighted_breadth >= 0.01 AND unique_reads > 0 AND best_entropy >= 0.2 AND unique_reads::DOUBLE / (unique_reads + multi_reads) >= 0.05 AS is_real FROM summ)"
STRICT = coverage.CoverageThresholds(min_unique_fraction=0.05)


@query(_ALL + f",{SUMMARY},{REAL} SELECT sample, taxon, unique_reads, multi_reads, is_real FROM real", "hits mask refs taxonomy")
def judge_real(spark, d):
    return coverage.judge_real(coverage.coverage_summary(strains_of(spark, d)[0]), STRICT, use_entropy=True).select("sample", "taxon", "unique_reads", "multi_reads", "is_real")


@query(_ALL + f",{SUMMARY} SELECT sample, taxon, unique_reads > multi_reads AND unique_reads + multi_reads >= 3 AND unmasked_weighted_breadth >= 0.01 AS is_real FROM summ", "hits mask refs taxonomy")
def judge_real_simple(spark, d):
    return coverage.judge_real(coverage.coverage_summary(strains_of(spark, d)[0]), coverage.DOCUMENTED, simple=True).select("sample", "taxon", "is_real")


ASSIGNED = "asg AS (SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY c.sample, query ORDER BY best_score DESC, best_identity DESC, working_taxid) AS j FROM cands c JOIN real r ON r.sample = c.sample AND r.taxon = c.working_taxid AND is_real) WHERE j = 1)"
ABUNDANCE = """
ab0 AS (SELECT sample, working_taxid, count(*) AS read_count FROM asg GROUP BY ALL),
ab1 AS (SELECT a.*, avg_genome_length, CASE WHEN avg_genome_length > 0 THEN read_count / (avg_genome_length / 1000) ELSE 0 END AS rpk FROM ab0 a LEFT JOIN real r ON a.sample = r.sample AND a.working_taxid = r.taxon),
ab AS (SELECT *, read_count::DOUBLE / sum(read_count) OVER (PARTITION BY sample) AS normalized_abundance, rpk / sum(rpk) OVER (PARTITION BY sample) AS length_norm_abundance, rpk / sum(rpk) OVER (PARTITION BY sample) * 1e6 AS tpm FROM ab1)"""
_AB = "round(rpk, 6) AS rpk, round(normalized_abundance, 9) AS normalized_abundance, round(length_norm_abundance, 9) AS length_norm_abundance, round(tpm, 4) AS tpm"


def classified(spark, d):
    strains, cands = strains_of(spark, d)
    judged = stage(coverage.judge_real(coverage.coverage_summary(strains), STRICT, use_entropy=True))
    real = judged.where("is_real").select("sample", F.col("taxon").alias("working_taxid"))
    return assign.assign_reads(cands, real), judged


def abundance_of(spark, d):
    assigned, judged = classified(spark, d)
    return coverage.abundance(assigned, judged.select("sample", F.col("taxon").alias("working_taxid"), "avg_genome_length"))


def _round_ab(rows):
    return rows.withColumns({"rpk": F.round("rpk", 6), "normalized_abundance": F.round("normalized_abundance", 9), "length_norm_abundance": F.round("length_norm_abundance", 9), "tpm": F.round("tpm", 4)})


@query(_ALL + f",{SUMMARY},{REAL},{ASSIGNED} SELECT sample, query, working_taxid, candidate_count, CASE WHEN candidate_count = 1 THEN 'unique' ELSE 'multi' END AS map_type FROM asg", "hits mask refs taxonomy")
def classify_coverage(spark, d):
    return classified(spark, d)[0].select("sample", "query", "working_taxid", "candidate_count", "map_type")


@query(_ALL + f",{SUMMARY},{REAL},{ASSIGNED},{ABUNDANCE} SELECT * REPLACE ({_AB}) FROM ab", "hits mask refs taxonomy")
def abundance_tpm(spark, d):
    return _round_ab(abundance_of(spark, d))


@query(_ALL + f",{SUMMARY},{REAL},{ASSIGNED},{ABUNDANCE}, kp AS (SELECT * FROM ab WHERE working_taxid % 5 <> 0) SELECT * REPLACE (round(rpk, 6) AS rpk, round(length_norm_abundance, 9) AS length_norm_abundance, round(tpm / sum(tpm) OVER (PARTITION BY sample) * 1e6, 4) AS tpm, round(read_count::DOUBLE / sum(read_count) OVER (PARTITION BY sample), 9) AS normalized_abundance) FROM kp", "hits mask refs taxonomy")
def resync_abundance(spark, d):
    rows = abundance_of(spark, d)
    return _round_ab(coverage.resync_abundance(rows, rows.where("working_taxid % 5 != 0")))


@query(_ALL + f",{SUMMARY},{REAL},{ASSIGNED} SELECT sample, query, working_taxid AS lca_taxid, l.name AS lca_name, l.rank AS lca_rank, 100 AS qlen, 1 AS read_count, 1 AS n_hits, candidate_count AS n_unique_taxids, CAST(working_taxid AS STRING) AS all_taxids FROM asg JOIN lin l ON l.taxid = working_taxid", "hits mask refs taxonomy")
def to_assignment_schema(spark, d):
    rows = assign.to_assignment_schema(classified(spark, d)[0], lin(spark, d))
    return rows.withColumn("all_taxids", F.array_join(F.col("all_taxids").cast("array<string>"), ","))


# --- counts, on best-hit assignments

_ASSIGN = "WITH" + LINEAGE + "," + BEST + ", asg AS (SELECT sample, query, taxid AS lca_taxid, 1 AS read_count, n_unique_taxids FROM best)"


def assigned_best(spark, d):
    return assign.best_hit(view(spark, d, "hits")).select("sample", "query", F.col("taxid").alias("lca_taxid"), F.lit(1).alias("read_count"), "n_unique_taxids")


@query(_ASSIGN + ", st AS (SELECT sample, lca_taxid, count(*) AS n, count(*) FILTER (n_unique_taxids = 1) AS u, sum(count(*)) OVER (PARTITION BY sample) AS t FROM asg GROUP BY sample, lca_taxid) SELECT a.sample, a.query, a.lca_taxid FROM asg a JOIN st USING (sample, lca_taxid) WHERE n::DOUBLE / t >= 0.005 AND u::DOUBLE / n >= 0.02 AND n >= 5", "hits taxonomy")
def fp_postfilter(spark, d):
    return counts.fp_postfilter(assigned_best(spark, d), 0.005, 0.02, 5).select("sample", "query", "lca_taxid")


CLADES = """
ct AS (SELECT sample, lca_taxid, sum(read_count) AS n FROM asg GROUP BY ALL), tt AS (SELECT sample, sum(n) AS t FROM ct GROUP BY ALL),
cl AS (SELECT sample, a AS taxid, sum(n)::BIGINT AS reads FROM ct JOIN anc ON anc.taxid = lca_taxid WHERE a <> 1 GROUP BY ALL),
clades AS (SELECT sample, cl.taxid, l.name, l.rank, reads, reads::DOUBLE / t AS abundance, CASE WHEN list_position(ids, 10239) > 0 THEN len(ids) - list_position(ids, 10239) END::INT AS depth, ids[-2] AS parent_taxid FROM cl JOIN lin l USING (taxid) JOIN tt USING (sample)),
direct AS (SELECT c.*, greatest(reads - coalesce((SELECT sum(reads) FROM clades b WHERE b.sample = c.sample AND b.parent_taxid = c.taxid), 0), 0)::BIGINT AS direct FROM clades c)"""


@query(_ASSIGN + f",{CLADES} SELECT * FROM clades", "hits taxonomy")
def clade_counts(spark, d):
    return counts.clade_counts(assigned_best(spark, d), lin(spark, d))


@query(_ASSIGN + f",{CLADES} SELECT * FROM direct", "hits taxonomy")
def direct_counts(spark, d):
    return counts.direct_counts(counts.clade_counts(assigned_best(spark, d), lin(spark, d)))


@query(_ASSIGN + f",{CLADES}, ky AS (SELECT c.sample, c.taxid, list({{'r': -s.reads, 't': s.taxid}} ORDER BY anc.d) AS k FROM clades c JOIN anc ON anc.taxid = c.taxid JOIN clades s ON s.sample = c.sample AND s.taxid = anc.a GROUP BY ALL) SELECT sample, taxid, row_number() OVER (PARTITION BY sample ORDER BY k)::INT AS line FROM ky", "hits taxonomy")
def kreport_order(spark, d):
    lineage = lin(spark, d)
    return counts.depth_first(counts.clade_counts(assigned_best(spark, d), lineage), lineage).select("sample", "taxid", "line")


@query(_ASSIGN + " SELECT sample, lca_taxid AS taxid, sum(read_count)::BIGINT AS value FROM asg GROUP BY ALL", "hits taxonomy")
def otu_table(spark, d):
    return counts.otu_table(assigned_best(spark, d))


_OTU = "otu AS (SELECT sample, CASE WHEN lca_taxid % 13 = 0 THEN -lca_taxid ELSE lca_taxid END AS taxid, sum(read_count)::BIGINT AS value FROM asg GROUP BY ALL)"


def otu(spark, d):
    rows = assigned_best(spark, d).withColumn("lca_taxid", F.when(F.col("lca_taxid") % 13 == 0, -F.col("lca_taxid")).otherwise(F.col("lca_taxid")))
    return counts.otu_table(rows)


@query(_ASSIGN + f",{_OTU},{rank_of('genus')} SELECT sample, taxid, sum(value)::BIGINT AS value FROM (SELECT sample, a AS taxid, value FROM otu JOIN up USING (taxid) UNION ALL SELECT sample, taxid, value FROM otu WHERE taxid < 0) GROUP BY ALL", "hits taxonomy")
def otu_at_rank(spark, d):
    return counts.otu_table_at_rank(otu(spark, d), lin(spark, d), "genus")


@query(_ASSIGN + f",{_OTU} SELECT o.*, concat(coalesce(name, 'unknown'), ' (', CAST(o.taxid AS STRING), ')') AS label FROM otu o LEFT JOIN lin USING (taxid)", "hits taxonomy")
def label_taxa(spark, d):
    return counts.label_taxa(otu(spark, d), lin(spark, d))


@query(_ASSIGN + f",{_OTU}, s AS (SELECT taxid, sum(value) AS t, count(DISTINCT CASE WHEN value > 0 THEN sample END) AS n FROM otu GROUP BY ALL) SELECT o.* FROM otu o JOIN s USING (taxid) WHERE t >= 20 AND n >= 2 AND n::DOUBLE / (SELECT count(DISTINCT sample) FROM otu) >= 0.6", "hits taxonomy")
def filter_otu(spark, d):
    return counts.filter_otu(otu(spark, d), 20, 2, 0.6)


@query(_ASSIGN + f",{_OTU} SELECT sample, taxid, value::DOUBLE / sum(value) OVER (PARTITION BY sample) AS value FROM otu", "hits taxonomy")
def normalize_otu(spark, d):
    return counts.normalize_otu(otu(spark, d))


@query(_ASSIGN + " SELECT s.sample, coalesce((SELECT sum(read_count) FROM asg a WHERE a.sample = s.sample), 0) <= 0 AS is_empty FROM (SELECT DISTINCT sample FROM hits UNION SELECT DISTINCT sample FROM counts) s", "hits taxonomy counts")
def nonempty_samples(spark, d):
    samples = view(spark, d, "hits").select("sample").union(view(spark, d, "counts").select("sample"))
    return counts.partition_nonempty_samples(assigned_best(spark, d), samples)


@query(_ASSIGN + f",{rank_of('species', 'ups')},{rank_of('genus', 'upg')}, r AS (SELECT sample, lca_taxid AS taxid, sum(read_count) AS n FROM asg GROUP BY ALL), x AS (SELECT sample, 'species' AS rank, coalesce(ups.an, '_unmapped') AS key, sum(n)::BIGINT AS reads FROM r LEFT JOIN ups USING (taxid) GROUP BY ALL UNION ALL SELECT sample, 'genus', coalesce(upg.an, '_unmapped'), sum(n)::BIGINT FROM r LEFT JOIN upg USING (taxid) GROUP BY ALL) SELECT *, reads::DOUBLE / sum(reads) OVER (PARTITION BY sample, rank) AS fraction FROM x", "hits taxonomy")
def taxon_rollups(spark, d):
    return counts.taxon_rollups(assigned_best(spark, d), lin(spark, d))


_BRIDGE = "dir AS (SELECT ncbi_taxid AS taxid, min(taxid) AS x FROM ictv WHERE ncbi_taxid IS NOT NULL GROUP BY 1), thr AS (SELECT taxid, min(ictv_taxid) AS y FROM refs WHERE ictv_taxid IS NOT NULL GROUP BY 1), br AS (SELECT coalesce(dir.taxid, thr.taxid) AS taxid, coalesce(x, y) AS other_taxid FROM dir FULL JOIN thr ON dir.taxid = thr.taxid)"


def bridge_of(spark, d):
    return host.ictv_bridge(view(spark, d, "ictv"), view(spark, d, "refs"))


@query(f"WITH {_BRIDGE} SELECT * FROM br", "ictv refs")
def ictv_bridge(spark, d):
    return bridge_of(spark, d)


@query("WITH" + LINEAGE.replace("FROM taxonomy", "FROM ictv").replace("taxid = 1", "taxid = 499999") + "," + BEST + f",{_BRIDGE},{rank_of('genus', 'upg')}, r AS (SELECT sample, other_taxid AS taxid, count(*) AS n FROM best LEFT JOIN br USING (taxid) GROUP BY ALL), x AS (SELECT sample, 'genus' AS rank, coalesce(upg.an, '_unmapped') AS key, sum(n)::BIGINT AS reads FROM r LEFT JOIN upg USING (taxid) GROUP BY ALL) SELECT *, reads::DOUBLE / sum(reads) OVER (PARTITION BY sample, rank) AS fraction FROM x", "hits ictv refs")
def taxon_rollups_second(spark, d):
    other = taxonomy.lineages(view(spark, d, "ictv"), root=499999)
    return counts.taxon_rollups(assigned_best(spark, d), other, ("genus",), bridge_of(spark, d))


_STEPS = "stl AS (SELECT sample, query, CASE WHEN sum(bits) > 300 THEN ['raw', 'qc', 'nonhost', 'aligned', 'confident'] WHEN sum(bits) > 200 THEN ['raw', 'qc', 'nonhost'] ELSE ['raw', 'qc'] END AS l FROM hits GROUP BY sample, query), steps AS (SELECT sample, query, unnest(l) AS step FROM stl)"


@query(f"WITH {_STEPS}, c AS (SELECT sample, count(DISTINCT CASE WHEN step = 'raw' THEN query END) AS raw, count(DISTINCT CASE WHEN step = 'qc' THEN query END) AS qc, count(DISTINCT CASE WHEN step = 'nonhost' THEN query END) AS nonhost, count(DISTINCT CASE WHEN step = 'aligned' THEN query END) AS aligned, count(DISTINCT CASE WHEN step = 'confident' THEN query END) AS confident FROM steps GROUP BY sample) SELECT *, qc::DOUBLE / raw * 100 AS qc_pct, nonhost::DOUBLE / raw * 100 AS nonhost_pct, aligned::DOUBLE / raw * 100 AS aligned_pct, confident::DOUBLE / raw * 100 AS confident_pct FROM c")
def pipeline_step_counts(spark, d):
    sums = view(spark, d, "hits").groupBy("sample", "query").agg(F.sum("bits").alias("b"))
    names = F.when(F.col("b") > 300, F.array(*map(F.lit, ["raw", "qc", "nonhost", "aligned", "confident"]))).when(F.col("b") > 200, F.array(*map(F.lit, ["raw", "qc", "nonhost"]))).otherwise(F.array(F.lit("raw"), F.lit("qc")))
    return counts.pipeline_step_counts(sums.select("sample", "query", F.explode(names).alias("step")))


# --- hosts


def _genus_sql(c):
    env = " OR ".join(f"contains(lower({c}), '{w}')" for w in ("metagenome", "sludge", "seawater", "sediment", "environment", "soil", "wastewater", "uncultured"))
    return f"CASE WHEN coalesce(trim({c}), '') = '' OR {env} OR starts_with(lower({c}), 'homo ') THEN NULL ELSE split_part(trim({c}), ' ', 1) END"


HOSTS = f"""
rh AS (SELECT r.*, coalesce(up.a, r.taxid) AS species_taxid, contains(lower(title), 'phage') AS phage, coalesce({_genus_sql('m.host')}, {_genus_sql('t.host')}) AS host
  FROM refs r LEFT JOIN up USING (taxid) LEFT JOIN metadata m ON m.accession = r.accession LEFT JOIN title_hosts t ON t.base_accession = r.accession),
pt AS (SELECT species_taxid, taxid, bool_or(phage) AS phage, arg_min(coalesce(host, ''), accession) AS host FROM rh GROUP BY ALL),
hosts AS (SELECT species_taxid, bool_or(phage) AS is_phage, arg_min(host, taxid) FILTER (host <> '') AS host FROM pt GROUP BY ALL)"""


def hosts_of(spark, d):
    return host.host_map(view(spark, d, "refs"), view(spark, d, "metadata"), view(spark, d, "title_hosts"), lin(spark, d))


@query("WITH" + LINEAGE + f",{rank_of('species')},{HOSTS} SELECT * FROM hosts", "refs metadata title_hosts taxonomy")
def host_map(spark, d):
    return hosts_of(spark, d)


@query(_ASSIGN + f",{rank_of('species')},{HOSTS} SELECT a.sample, a.query, CASE WHEN is_phage AND host IS NOT NULL THEN concat('phages_of_', host) ELSE l.name END AS lca_name, CASE WHEN is_phage AND host IS NOT NULL THEN 'host_genus' ELSE l.rank END AS lca_rank, coalesce(is_phage AND host IS NOT NULL, false) AS negative FROM asg a JOIN lin l ON l.taxid = a.lca_taxid LEFT JOIN up ON up.taxid = a.lca_taxid LEFT JOIN hosts h ON h.species_taxid = coalesce(up.a, a.lca_taxid)", "hits refs metadata title_hosts taxonomy")
def phage_host_rollup(spark, d):
    lineage = lin(spark, d)
    rows = assigned_best(spark, d).join(lineage.select(F.col("taxid").alias("lca_taxid"), F.col("name").alias("lca_name"), F.col("rank").alias("lca_rank")), "lca_taxid")
    return host.phage_host_rollup(rows, hosts_of(spark, d), lineage).select("sample", "query", "lca_name", "lca_rank", (F.col("lca_taxid") < 0).alias("negative"))


@query("SELECT accession, CASE WHEN accession LIKE '%_0' AND taxid % 3 = 0 THEN 'Kept' WHEN taxid % 3 = 1 AND taxid % 4 <> 0 THEN concat('Genus', chr(97 + taxid % 4)) ELSE '' END AS host FROM refs", "refs")
def fill_hosts_from_titles(spark, d):
    r = view(spark, d, "refs").selectExpr("accession", "CASE WHEN taxid % 3 = 1 THEN concat('Genus', chr(97 + taxid % 4), ' phage A', taxid) ELSE concat('Lone', taxid, ' phage') END AS title", "CASE WHEN accession LIKE '%_0' AND taxid % 3 = 0 THEN 'Kept' ELSE '' END AS host")
    genera = spark.createDataFrame([("Genusb",), ("Genusc",), ("Genusd",), ("Other",)], "name string")
    return host.fill_hosts_from_titles(r, genera).select("accession", "host")


@query("WITH" + LINEAGE + """, own AS (SELECT ncbi_taxid AS taxid, min(molecule) AS c1 FROM ictv WHERE ncbi_taxid IS NOT NULL AND taxid % 3 = 0 GROUP BY 1), nm AS (SELECT name, min(molecule) AS c2 FROM ictv WHERE rank = 'species' AND molecule IS NOT NULL GROUP BY 1), b AS (SELECT 'AFRICA' AS name, 'RT' AS type UNION ALL SELECT 'NATION_3', 'ssRNA'),
 cl AS (SELECT taxid, arg_max(type, d) AS c3 FROM anc JOIN b ON b.name = anc.an GROUP BY taxid),
 g AS (SELECT t.taxid, t.name, coalesce(c1, c2) AS c, c3 FROM taxonomy t LEFT JOIN own USING (taxid) LEFT JOIN nm USING (name) LEFT JOIN cl USING (taxid))
 SELECT taxid, name, coalesce(CASE WHEN contains(c, 'dsDNA') THEN 'dsDNA' WHEN contains(c, 'ssRNA') THEN 'ssRNA' WHEN contains(c, 'ssDNA') THEN 'ssDNA' END, c3, 'Other') AS genome_type FROM g""", "ictv taxonomy")
def genome_type(spark, d):
    t, i = view(spark, d, "taxonomy"), view(spark, d, "ictv")
    vmr = i.where("ncbi_taxid is not null and taxid % 3 = 0").selectExpr("ncbi_taxid", "molecule AS genome_comp")
    by_clade = spark.createDataFrame([("AFRICA", "RT"), ("NATION_3", "ssRNA")], "name string, type string")
    return host.genome_type_label(t.select("taxid", "name"), vmr, i, taxonomy.lineages(t), by_clade)


@query("SELECT taxid, coalesce(sum(CASE WHEN NOT regexp_matches(lower(title), '\\b(gene|partial)\\b') THEN length END), sum(length))::BIGINT AS length FROM refs GROUP BY taxid", "refs")
def species_genome_length(spark, d):
    return host.species_genome_length(view(spark, d, "refs"))


@query("WITH" + LINEAGE + f",{rank_of('species')},{HOSTS}, mem AS (SELECT species_taxid AS taxid, host FROM hosts WHERE is_phage AND host IS NOT NULL), sz AS (SELECT host, avg(length) AS length FROM mem JOIN lengths USING (taxid) GROUP BY host), r AS (SELECT sample, host, sum(reads)::BIGINT AS reads FROM counts JOIN mem USING (taxid) GROUP BY ALL) SELECT sample, host, reads, length, round(reads / (length / 1000), 6) AS rpk, round(reads / (length / 1000) / sum(reads / (length / 1000)) OVER (PARTITION BY sample) * 1e6, 4) AS tpm FROM r JOIN sz USING (host)", "refs metadata title_hosts taxonomy counts lengths")
def host_group_tpm(spark, d):
    rows = host.host_group_tpm(view(spark, d, "counts"), hosts_of(spark, d), view(spark, d, "lengths"))
    return rows.withColumns({"rpk": F.round("rpk", 6), "tpm": F.round("tpm", 4)})


@query("WITH" + LINEAGE + "," + lca("hits", "sample, query") + " SELECT lca_taxid, count(*) AS reads FROM lca GROUP BY 1", "hits taxonomy")
def lca_counts(spark, d):
    rows = taxonomy.lca_of_sets(view(spark, d, "hits").select("sample", "query", "taxid"), lin(spark, d), ("sample", "query"))
    return rows.groupBy("lca_taxid").agg(F.count("*").alias("reads"))
