"""Queries on cohorts, accuracy, sweeps, EM, the detection model and reads, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from hitloom.functions.kmers import MASK
from hitloom.functions.stage import stage
from hitloom.operators import assign, cohort, em, evaluate, hits, ml, reads, taxonomy
from hitloom.plans import q_cover
from hitloom.plans.common_sql import BEST, MASKED
from hitloom.plans.derive import oracle, view

QUERIES, SQL = {}, {}


def query(sql: str | None = None, views: str = "counts cohort"):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = oracle(views, sql)
        return f

    return add


def rnd(rows, *names, digits=9):
    return rows.withColumns({n: F.round(n, digits) for n in names})


ALPHA = "al AS (SELECT sample, count(*) AS richness, -sum(p * ln(p)) AS shannon, 1 / sum(p * p) AS inverse_simpson FROM (SELECT sample, reads::DOUBLE / sum(reads) OVER (PARTITION BY sample) AS p FROM counts WHERE reads > 0) GROUP BY sample)"


@query(f"WITH {ALPHA} SELECT sample, richness, round(shannon, 9) AS shannon, round(inverse_simpson, 9) AS inverse_simpson, round(CASE WHEN richness > 1 THEN shannon / ln(richness) ELSE 0 END, 9) AS pielou FROM al")
def alpha_diversity(spark, d):
    return rnd(cohort.alpha_diversity(view(spark, d, "counts")), "shannon", "inverse_simpson", "pielou")


BRAY = "bc AS (SELECT x.sample AS a, y.sample AS b, 1 - 2 * coalesce((SELECT sum(least(p.reads, q.reads)) FROM counts p JOIN counts q USING (taxid) WHERE p.sample = x.sample AND q.sample = y.sample), 0)::DOUBLE / (x.t + y.t) AS distance FROM (SELECT sample, sum(reads) AS t FROM counts GROUP BY 1) x JOIN (SELECT sample, sum(reads) AS t FROM counts GROUP BY 1) y ON x.sample < y.sample)"


@query(f"WITH {BRAY} SELECT a, b, round(distance, 9) AS distance FROM bc")
def bray_curtis(spark, d):
    return rnd(cohort.bray_curtis(view(spark, d, "counts")), "distance")


@query()
def pcoa(spark, d):
    return rnd(cohort.pcoa(cohort.bray_curtis(view(spark, d, "counts"))), "axis1", "axis2", "explained1", "explained2", digits=6)


@query(f"WITH {BRAY}, n AS (SELECT grp, count(*) AS n FROM cohort GROUP BY grp), w AS (SELECT sum(distance * distance / n.n) AS sw FROM bc JOIN cohort x ON x.sample = a JOIN cohort y ON y.sample = b AND x.grp = y.grp JOIN n ON n.grp = x.grp), t AS (SELECT sum(distance * distance) / (SELECT count(*) FROM cohort) AS st FROM bc) SELECT round(((st - sw) / ((SELECT count(*) FROM n) - 1)) / (sw / ((SELECT count(*) FROM cohort) - (SELECT count(*) FROM n))), 7) AS pseudo_f, (SELECT count(*) FROM cohort)::INT AS samples, (SELECT count(*) FROM n)::INT AS n_groups FROM w, t")
def permanova_f(spark, d):
    distances = cohort.bray_curtis(view(spark, d, "counts"))
    return rnd(cohort.permanova(distances, view(spark, d, "cohort"), 99).drop("p_value"), "pseudo_f", digits=7)


@query()
def permanova(spark, d):
    distances = cohort.bray_curtis(view(spark, d, "counts"))
    return rnd(cohort.permanova(distances, view(spark, d, "cohort"), 999), "pseudo_f")


_VAL = "val AS (SELECT taxid % 6 AS k, grp, reads AS value FROM counts JOIN cohort USING (sample)), rk AS (SELECT *, count(*) OVER (PARTITION BY k, value) AS t, rank() OVER (PARTITION BY k ORDER BY value) + (count(*) OVER (PARTITION BY k, value) - 1) / 2.0 AS r FROM val)"


def values(spark, d):
    return view(spark, d, "counts").join(view(spark, d, "cohort"), "sample").select((F.col("taxid") % 6).alias("k"), "group", F.col("reads").alias("value"))


@query(f"WITH {_VAL}, s AS (SELECT k, count(*) FILTER (grp = 'case') AS n1, count(*) FILTER (grp = 'control') AS n2, sum(CASE WHEN grp = 'case' THEN r END)::DOUBLE AS r1, sum(t * t - 1)::DOUBLE AS ties FROM rk GROUP BY k), u AS (SELECT *, r1 - n1 * (n1 + 1) / 2.0 AS u FROM s) SELECT k, n1, n2, u::DOUBLE AS u, round(sign(u - n1 * n2 / 2.0) * greatest(abs(u - n1 * n2 / 2.0) - 0.5, 0) / sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1)))), 7) AS z, round(2 * u / (n1 * n2) - 1, 9) AS rank_biserial FROM u")
def mann_whitney_u(spark, d):
    return rnd(rnd(cohort.mann_whitney(values(spark, d), ("k",), "case", "control").drop("p_value"), "rank_biserial"), "z", digits=7)


def two_sided(density: str, upper: str, steps: int = 2000) -> str:
    """SQL of 1 - 2 * the integral of a density of x from 0 to `upper`, by Simpson's rule."""
    weight = f"CASE WHEN i IN (0, {steps}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    at = density.replace("x", f"({upper} * i / {steps})")
    return f"(1 - 2 * {upper} / {3 * steps} * (SELECT sum({weight} * {at}) FROM range({steps + 1}) steps(i)))"


_NORMAL = "1 / sqrt(2 * pi()) * pow(2.718281828459045, -(x * x) / 2)"


@query(f"SELECT *, round({two_sided(_NORMAL, 'abs(z)')}, 6) AS p_value FROM ({SQL['mann_whitney_u']})")
def mann_whitney(spark, d):
    return rnd(rnd(rnd(cohort.mann_whitney(values(spark, d), ("k",), "case", "control"), "rank_biserial"), "z", digits=7), "p_value", digits=6)


_FEW = "val AS (SELECT taxid AS k, CASE WHEN sample[2:]::INT % 4 = 0 THEN 'few' ELSE 'many' END AS grp, reads * 100 + sample[2:]::INT AS value FROM counts), rk AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY value) AS r FROM val), st AS (SELECT k, count(*) FILTER (grp = 'few') AS n1, count(*) FILTER (grp = 'many') AS n2, sum(CASE WHEN grp = 'few' THEN r END) AS r1 FROM rk GROUP BY k HAVING count(*) FILTER (grp = 'few') > 0 AND count(*) FILTER (grp = 'many') > 0), us AS (SELECT *, r1 - n1 * (n1 + 1) // 2 AS u FROM st)"
# ways to take c of the first i ranks with the sum s, one rank after the other
_WAYS = "ways AS (SELECT 0 AS i, 0 AS c, 0 AS s, 1::HUGEINT AS n UNION ALL SELECT i + 1, c + t, s + t * (i + 1), sum(n)::HUGEINT FROM ways, (SELECT unnest([0, 1]) AS t) WHERE i < 24 AND c + t <= 6 GROUP BY ALL)"


@query(f"WITH {_FEW}, {_WAYS} SELECT k, n1, n2, u::DOUBLE AS u, round(least(1.0, 2 * (SELECT sum(n) FROM ways WHERE i = n1 + n2 AND c = n1 AND s - n1 * (n1 + 1) // 2 >= greatest(u, n1 * n2 - u))::DOUBLE / (SELECT sum(n) FROM ways WHERE i = n1 + n2 AND c = n1)::DOUBLE), 9) AS p_value FROM us", "counts")
def mann_whitney_exact(spark, d):
    few = F.expr("CASE WHEN CAST(substring(sample, 2) AS INT) % 4 = 0 THEN 'few' ELSE 'many' END")
    rows = view(spark, d, "counts").select(F.col("taxid").alias("k"), few.alias("group"), F.expr("reads * 100 + CAST(substring(sample, 2) AS INT)").alias("value"))
    return rnd(cohort.mann_whitney(rows, ("k",), "few", "many").drop("z", "rank_biserial"), "p_value")


_KW = _VAL.replace("grp, reads AS value", "CASE WHEN taxid % 3 = 0 THEN 'x' ELSE grp END AS grp, reads AS value")


@query(f"WITH {_KW}, g AS (SELECT k, grp, sum(r) AS r, count(*) AS n, sum(t * t - 1) AS ties FROM rk GROUP BY ALL), s AS (SELECT k, sum(r * r / n)::DOUBLE AS q, sum(n)::DOUBLE AS n, sum(ties)::DOUBLE AS ties, count(*) - 1 AS df FROM g GROUP BY k) SELECT k, round((12 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - ties / (n * n * n - n)), 7) AS h, df FROM s WHERE df > 0")
def kruskal_h(spark, d):
    rows = view(spark, d, "counts").join(view(spark, d, "cohort"), "sample").select((F.col("taxid") % 6).alias("k"), F.when(F.col("taxid") % 3 == 0, "x").otherwise(F.col("group")).alias("group"), F.col("reads").alias("value"))
    return rnd(cohort.kruskal_wallis(rows, ("k",)).where("df > 0").drop("p_value"), "h", digits=7)


@query(f"SELECT k, h, df, round({two_sided(_NORMAL, 'sqrt(h)')}, 5) AS p_value FROM ({SQL['kruskal_h']})")
def kruskal_wallis(spark, d):
    """Two groups in each k that is tested, so H has one degree of freedom and is the square of a normal variable."""
    rows = view(spark, d, "counts").join(view(spark, d, "cohort"), "sample").select((F.col("taxid") % 6).alias("k"), F.when(F.col("taxid") % 3 == 0, "x").otherwise(F.col("group")).alias("group"), F.col("reads").alias("value"))
    return rnd(rnd(cohort.kruskal_wallis(rows, ("k",)).where("df > 0"), "h", digits=7), "p_value", digits=5)


@query("WITH p AS (SELECT taxid, (1 + taxid * 37 % 100)::DOUBLE / 101 AS p_value FROM (SELECT DISTINCT taxid FROM counts)), r AS (SELECT *, p_value * count(*) OVER () / count(*) OVER (ORDER BY p_value) AS raw FROM p) SELECT taxid, p_value, round(least(1.0, min(raw) OVER (ORDER BY p_value DESC)), 9) AS q_value FROM r")
def bh_fdr(spark, d):
    p = view(spark, d, "counts").select("taxid").distinct().withColumn("p_value", (1 + F.col("taxid") * 37 % 100).cast("double") / 101)
    return rnd(cohort.bh_fdr(p), "q_value")


@query("WITH j AS (SELECT grp, taxid % 10 AS label, sample, reads FROM counts JOIN cohort USING (sample)), n AS (SELECT grp, count(DISTINCT sample) AS n FROM j GROUP BY grp), s AS (SELECT grp, label, sum(reads)::DOUBLE / any_value(n) AS m FROM j JOIN n USING (grp) GROUP BY ALL) SELECT grp, label, round(m / sum(m) OVER (PARTITION BY grp), 9) AS share FROM s")
def mean_composition(spark, d):
    rows = view(spark, d, "counts").join(view(spark, d, "cohort"), "sample").withColumn("label", F.col("taxid") % 10)
    return rnd(cohort.mean_composition(rows, ("group",), "label", "reads"), "share").withColumnRenamed("group", "grp")


def _rpk(missing, other):
    def f(spark, d):
        return rnd(cohort.rpk_share(view(spark, d, "counts"), view(spark, d, "lengths"), missing), "rpk", "share")

    f.__name__ = f"rpk_share_{missing}"
    query(f"WITH r AS (SELECT sample, c.taxid, reads, CASE WHEN length > 0 THEN reads / (length / 1000.0) ELSE {other} END::DOUBLE AS rpk FROM counts c LEFT JOIN lengths USING (taxid)) SELECT sample, taxid, reads, round(rpk, 9) AS rpk, round(CASE WHEN sum(rpk) OVER (PARTITION BY sample) > 0 THEN rpk / sum(rpk) OVER (PARTITION BY sample) ELSE 0 END, 9) AS share FROM r", "counts lengths")(f)


_rpk("zero", "0")
_rpk("reads", "reads")


@query("WITH b AS (SELECT taxid FROM counts GROUP BY taxid ORDER BY max(reads) DESC, taxid LIMIT 7) SELECT sample, CASE WHEN taxid IN (SELECT taxid FROM b) THEN CAST(taxid AS STRING) ELSE 'Other' END AS taxid, sum(reads)::BIGINT AS reads FROM counts GROUP BY ALL")
def top_n_other(spark, d):
    rows = view(spark, d, "counts").withColumn("taxid", F.col("taxid").cast("string"))
    return cohort.top_n_other(rows, "taxid", "reads", 7).groupBy("sample", "taxid").agg(F.sum("reads").alias("reads"))


@query("WITH f AS (SELECT taxid, bool_or(grp = 'case') AS a, bool_or(grp = 'control') AS b FROM counts JOIN cohort USING (sample) WHERE reads > 40 GROUP BY taxid) SELECT count(*) FILTER (a AND NOT b) AS first_only, count(*) FILTER (a AND b) AS shared, count(*) FILTER (b AND NOT a) AS second_only FROM f")
def taxa_overlap(spark, d):
    return cohort.taxa_overlap(view(spark, d, "counts").where("reads > 40").join(view(spark, d, "cohort"), "sample"), "case", "control")


@query("SELECT c.sample, coalesce(n, 0) AS n FROM cohort c LEFT JOIN (SELECT sample, count(*) AS n FROM counts WHERE sample <> 'c3' GROUP BY 1) USING (sample)")
def zero_fill_manifest(spark, d):
    n = view(spark, d, "counts").where("sample != 'c3'").groupBy("sample").agg(F.count("*").alias("n"))
    return cohort.zero_fill_manifest(view(spark, d, "cohort").select("sample"), n, ["n"])


@query("SELECT sample, sum(CASE WHEN taxid % 3 = 0 THEN reads ELSE 0 END)::BIGINT AS phage_reads, sum(CASE WHEN taxid % 3 = 0 THEN 0 ELSE reads END)::BIGINT AS other_reads, count(DISTINCT CASE WHEN taxid % 3 = 0 THEN taxid END) AS phage_taxa, count(DISTINCT CASE WHEN taxid % 3 <> 0 THEN taxid END) AS other_taxa, sum(CASE WHEN taxid % 3 = 0 THEN reads ELSE 0 END)::DOUBLE / sum(reads) AS phage_fraction FROM counts GROUP BY sample")
def kind_split(spark, d):
    return cohort.kind_split(view(spark, d, "counts").withColumn("is_phage", F.col("taxid") % 3 == 0), ("sample",))


_TOT = "tot AS (SELECT cohort, grp, sample, sum(reads)::BIGINT AS total FROM counts JOIN cohort USING (sample) GROUP BY ALL)"


@query(f"WITH {_TOT}, st AS (SELECT cohort, grp, coalesce(sum(n + 2) OVER (PARTITION BY cohort ORDER BY grp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM (SELECT cohort, grp, count(*) AS n FROM tot GROUP BY ALL)) SELECT t.cohort, t.grp, sample, total, (start + row_number() OVER (PARTITION BY t.cohort, t.grp ORDER BY total DESC, sample) - 1)::BIGINT AS place FROM tot t JOIN st ON st.cohort = t.cohort AND st.grp = t.grp")
def sample_layout(spark, d):
    t = view(spark, d, "counts").join(view(spark, d, "cohort"), "sample").groupBy("cohort", "group", "sample").agg(F.sum("reads").alias("total"))
    return cohort.sample_layout(t).withColumnRenamed("group", "grp")


@query("WITH s AS (SELECT sample, sum(reads)::BIGINT AS size, row_number() OVER (ORDER BY sum(reads), sample) - 1 AS k, count(*) OVER () AS n FROM counts GROUP BY sample) SELECT sample, size FROM s WHERE k IN (SELECT (i * (n - 1) + 2) // 4 FROM (SELECT unnest(range(5)) AS i))")
def even_representatives(spark, d):
    return cohort.even_representatives(view(spark, d, "counts").groupBy("sample").agg(F.sum("reads").alias("size")), 5)


_GT = "CASE taxid % 4 WHEN 0 THEN 'ssRNA' WHEN 1 THEN 'dsRNA' WHEN 2 THEN 'dsDNA' ELSE 'Other' END"


@query(f"WITH s AS (SELECT sample, {_GT} AS genome_type, sum(reads)::BIGINT AS reads FROM counts GROUP BY ALL) SELECT *, reads::DOUBLE / sum(reads) OVER (PARTITION BY sample) AS fraction FROM s")
def genome_type_fractions(spark, d):
    return cohort.genome_type_fractions(view(spark, d, "counts").withColumn("genome_type", F.expr(_GT)))


@query(f"SELECT sample, round(sum(CASE WHEN {_GT} IN ('ssRNA', 'dsRNA') THEN reads ELSE 0 END)::DOUBLE / sum(reads), 9) AS rna_share FROM counts GROUP BY sample")
def rna_virus_capture(spark, d):
    return rnd(cohort.rna_capture(cohort.genome_type_fractions(view(spark, d, "counts").withColumn("genome_type", F.expr(_GT)))), "rna_share")


@query("SELECT sample, count(DISTINCT taxid) AS n_species, sum(reads)::BIGINT AS reads FROM counts WHERE reads > 0 GROUP BY sample")
def depth_richness(spark, d):
    return cohort.depth_richness(view(spark, d, "counts"))


_MAT = "ms AS (SELECT sample, taxid, sum(CASE WHEN taxid % 10 = 3 THEN 0 ELSE reads END)::BIGINT AS value FROM counts WHERE sample <> 'c5' GROUP BY ALL), mat AS (SELECT c.sample, f.taxid, coalesce(value, 0) AS value FROM cohort c CROSS JOIN (SELECT taxid FROM ms GROUP BY taxid HAVING sum(abs(value)) > 0) f LEFT JOIN ms USING (sample, taxid))"


def matrix(spark, d):
    rows = view(spark, d, "counts").where("sample != 'c5'").withColumn("reads", F.when(F.col("taxid") % 10 == 3, 0).otherwise(F.col("reads")))
    return cohort.feature_matrix(rows, view(spark, d, "cohort"), "taxid", "reads")


@query(f"WITH {_MAT} SELECT * FROM mat")
def feature_matrix(spark, d):
    return matrix(spark, d)


@query("SELECT taxid, " + ", ".join(f"sum(CASE WHEN sample = 'c{i}' THEN reads ELSE 0 END)::BIGINT AS c{i}" for i in range(24)) + " FROM counts GROUP BY taxid")
def otu_matrix_wide(spark, d):
    return cohort.pivot_samples(view(spark, d, "counts"), "taxid", [f"c{i}" for i in range(24)], "reads")


_TOOLS = "tl AS (SELECT concat('tool', CAST(sample[2:]::INT % 3 AS STRING)) AS tool, sample, taxid, concat('n', CAST(taxid AS STRING)) AS name, reads FROM counts WHERE (taxid + sample[2:]::INT % 3) % 4 <> 0)"


def tools(spark, d):
    n = F.expr("CAST(substring(sample, 2) AS INT) % 3")
    return view(spark, d, "counts").where((F.col("taxid") + n) % 4 != 0).select(F.concat(F.lit("tool"), n.cast("string")).alias("tool"), "sample", "taxid", F.concat(F.lit("n"), F.col("taxid").cast("string")).alias("name"), "reads")


@query(f"WITH {_TOOLS}, t AS (SELECT taxid, count(DISTINCT tool) AS k, sum(reads)::BIGINT AS r FROM tl GROUP BY taxid) SELECT taxid, 'shared' AS kind, NULL AS tool, r AS reads FROM (SELECT * FROM t WHERE k >= 3 ORDER BY r DESC, taxid LIMIT 5) UNION ALL SELECT taxid, 'specific', tool, r FROM (SELECT tool, taxid, sum(reads)::BIGINT AS r, row_number() OVER (PARTITION BY tool ORDER BY sum(reads) DESC, taxid) AS j FROM tl WHERE taxid NOT IN (SELECT taxid FROM t WHERE k >= 3) GROUP BY tool, taxid) WHERE j <= 4")
def shared_and_specific_taxa(spark, d):
    return cohort.shared_and_specific(tools(spark, d), 3, 5, 4)


@query(f"WITH {_TOOLS}, s AS (SELECT tool, sample, taxid, name, sum(reads)::BIGINT AS reads FROM tl GROUP BY ALL) SELECT *, reads::DOUBLE / sum(reads) OVER (PARTITION BY tool, sample) AS rel_abund FROM s")
def species_long(spark, d):
    return cohort.species_long([tools(spark, d).where("taxid % 2 = 0"), tools(spark, d).where("taxid % 2 = 1")])


@query(f"WITH {_TOOLS}, n AS (SELECT tool, sample, count(DISTINCT taxid) AS n FROM tl WHERE reads > 0 GROUP BY ALL), f AS (SELECT x.tool, c.sample, coalesce(n, 0) AS n FROM (SELECT DISTINCT tool FROM tl) x CROSS JOIN cohort c LEFT JOIN n ON n.tool = x.tool AND n.sample = c.sample) SELECT tool, round(avg(n), 9) AS mean_richness, quantile_cont(n, 0.5) AS median_richness, count(*) AS samples FROM f GROUP BY tool")
def richness_summary(spark, d):
    return rnd(cohort.richness_summary(tools(spark, d), view(spark, d, "cohort")), "mean_richness")


_PTS = "SELECT grp, reads::DOUBLE AS axis1, (taxid % 50)::DOUBLE AS axis2 FROM counts JOIN cohort USING (sample)"


@query(f"WITH p AS ({_PTS}) SELECT grp, round(avg(axis1), 7) AS mean1, round(avg(axis2), 7) AS mean2, round(var_samp(axis1), 5) AS var1, round(var_samp(axis2), 5) AS var2, round(covar_samp(axis1, axis2), 5) AS cov, count(*) AS n FROM p GROUP BY grp")
def group_ellipse(spark, d):
    p = view(spark, d, "counts").join(view(spark, d, "cohort"), "sample").select("group", F.col("reads").cast("double").alias("axis1"), (F.col("taxid") % 50).cast("double").alias("axis2"))
    return rnd(rnd(cohort.group_ellipse(p), "mean1", "mean2", digits=7), "var1", "var2", "cov", digits=5).withColumnRenamed("group", "grp")


@query(f"WITH {_MAT}, sh AS (SELECT taxid AS feature, (grp = 'case')::INT AS x, coalesce(value::DOUBLE / nullif(sum(value) OVER (PARTITION BY sample), 0), 0) AS share FROM mat JOIN cohort USING (sample)), e AS (SELECT *, avg((share > 0)::INT) OVER (PARTITION BY feature) AS prevalence, min(CASE WHEN share > 0 THEN share END) OVER (PARTITION BY feature) AS least FROM sh), y AS (SELECT *, log2(CASE WHEN share > 0 THEN share ELSE least / 2 END) AS y FROM e WHERE prevalence >= 0.1), s AS (SELECT feature, any_value(prevalence) AS prevalence, count(*) FILTER (x = 0) AS n0, count(*) FILTER (x = 1) AS n1, avg(y) FILTER (x = 0) AS m0, avg(y) FILTER (x = 1) AS m1, var_pop(y) FILTER (x = 0) AS v0, var_pop(y) FILTER (x = 1) AS v1 FROM y GROUP BY feature) SELECT feature, round(prevalence, 9) AS prevalence, round(m1 - m0, 7) AS slope, round((m1 - m0) / sqrt((v0 * n0 + v1 * n1) / (n0 + n1 - 2) * (1.0 / n0 + 1.0 / n1)), 6) AS t FROM s")
def differential_abundance_t(spark, d):
    m = matrix(spark, d).withColumnRenamed("taxid", "feature")
    rows = cohort.differential_abundance(m, view(spark, d, "cohort"), "case").drop("p_value", "q_value")
    return rnd(rnd(rnd(rows, "prevalence"), "slope", digits=7), "t", digits=6)


_ROUNDED = ("round(prevalence, 9) AS prevalence, round(m1 - m0, 7) AS slope, round((m1 - m0) / sqrt(", "), 6) AS t FROM s")
_PLAIN = SQL["differential_abundance_t"].replace(_ROUNDED[0], "prevalence, m1 - m0 AS slope, (m1 - m0) / sqrt(").replace(_ROUNDED[1], ") AS t FROM s")  # p is that of t itself
_STUDENT = "gamma(11.5) / gamma(11) / sqrt(22 * pi()) * pow(1 + x * x / 22, -11.5)"


@query(
    f"WITH tt AS ({_PLAIN}), p AS (SELECT *, {two_sided(_STUDENT, 'abs(t)')} AS p FROM tt), r AS (SELECT *, p * count(*) OVER () / count(*) OVER (ORDER BY p) AS raw FROM p WHERE t IS NOT NULL)"
    " SELECT feature, round(prevalence, 9) AS prevalence, round(slope, 7) AS slope, round(t, 6) AS t, round(p, 4) AS p_value, round(least(1.0, min(raw) OVER (ORDER BY p DESC)), 4) AS q_value FROM r"
)
def differential_abundance(spark, d):
    """24 samples, so t has 22 degrees of freedom."""
    rows = cohort.differential_abundance(matrix(spark, d).withColumnRenamed("taxid", "feature"), view(spark, d, "cohort"), "case")
    return rnd(rnd(rnd(rnd(rows, "prevalence"), "slope", digits=7), "t", digits=6), "p_value", "q_value", digits=4)


@query(f"WITH {_MAT}, s AS (SELECT taxid AS feature, count(*) FILTER (grp = 'case' AND value > 40) AS a, count(*) FILTER (grp = 'case' AND value <= 40) AS b, count(*) FILTER (grp <> 'case' AND value > 40) AS c, count(*) FILTER (grp <> 'case' AND value <= 40) AS d FROM mat JOIN cohort USING (sample) GROUP BY 1) SELECT *, round(ln((a + 0.5) * (d + 0.5) / ((b + 0.5) * (c + 0.5))), 7) AS log_odds, round(ln((a + 0.5) * (d + 0.5) / ((b + 0.5) * (c + 0.5))) / sqrt(1 / (a + 0.5) + 1 / (b + 0.5) + 1 / (c + 0.5) + 1 / (d + 0.5)), 7) AS z FROM s")
def differential_prevalence(spark, d):
    m = matrix(spark, d).selectExpr("sample", "taxid AS feature", "greatest(value - 40, 0) AS value")
    return rnd(cohort.differential_prevalence(m, view(spark, d, "cohort"), "case").drop("p_value", "q_value"), "log_odds", "z", digits=7)


@query()
def clr_effect(spark, d):
    m = matrix(spark, d).withColumnRenamed("taxid", "feature")
    return rnd(cohort.clr_effect(m, view(spark, d, "cohort"), "case", "control"), "p_value", "p_wilcoxon", "effect", "q_value", digits=6)


# --- accuracy

_CALLS = "calls AS (SELECT DISTINCT sample, taxid FROM counts WHERE reads > 40)"
SCORES = "sc AS (SELECT sample, count(DISTINCT truth_group) AS tp, count(*) FILTER (truth_group IS NULL) AS fp, (SELECT count(DISTINCT truth_group) FROM truth) AS n FROM calls LEFT JOIN truth USING (taxid) GROUP BY sample), scores AS (SELECT sample, tp, fp, n - tp AS fn, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision, coalesce(tp::DOUBLE / nullif(n, 0), 0) AS recall FROM sc), scored AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM scores)"


def scores_of(spark, d):
    return evaluate.score_detection(view(spark, d, "counts").where("reads > 40"), view(spark, d, "truth"))


@query(f"WITH {_CALLS},{SCORES} SELECT * FROM scored", "counts truth")
def score_detection(spark, d):
    return scores_of(spark, d)


_SHARES = "tg AS (SELECT truth_group, max(length) AS gl FROM truth JOIN lengths USING (taxid) GROUP BY 1), ln AS (SELECT taxid, truth_group, coalesce(length, gl) AS length FROM truth LEFT JOIN lengths USING (taxid) LEFT JOIN tg USING (truth_group)), s0 AS (SELECT sample, truth_group, sum(reads)::BIGINT AS reads, sum(coalesce(reads / (length / 1000.0), 0))::DOUBLE AS rpk FROM counts JOIN ln USING (taxid) GROUP BY ALL), shares AS (SELECT *, reads::DOUBLE / sum(reads) OVER (PARTITION BY sample) AS raw_share, coalesce(rpk / nullif(sum(rpk) OVER (PARTITION BY sample), 0), 0) AS share FROM s0)"


def shares_of(spark, d):
    return evaluate.truth_shares(view(spark, d, "counts"), view(spark, d, "truth"), view(spark, d, "lengths"))


@query(f"WITH {_SHARES} SELECT sample, truth_group, reads, round(rpk, 7) AS rpk, round(raw_share, 9) AS raw_share, round(share, 9) AS share FROM shares", "counts truth lengths")
def truth_composition(spark, d):
    return rnd(rnd(shares_of(spark, d), "raw_share", "share"), "rpk", digits=7)


@query(f"WITH {_SHARES}, e AS (SELECT DISTINCT truth_group, 1.0 / (SELECT count(DISTINCT truth_group) FROM truth) AS expected FROM truth) SELECT c.sample, round(avg(abs(coalesce(share, 0) - expected)), 9) AS vae FROM (SELECT DISTINCT sample FROM counts) c CROSS JOIN e LEFT JOIN shares s ON s.sample = c.sample AND s.truth_group = e.truth_group GROUP BY 1", "counts truth lengths")
def abundance_error(spark, d):
    groups = view(spark, d, "truth").select("truth_group").distinct()
    expected = groups.crossJoin(groups.agg((F.lit(1.0) / F.count("*")).alias("expected")))
    return rnd(evaluate.abundance_error(shares_of(spark, d), expected, view(spark, d, "counts")), "vae")


@query("WITH s AS (SELECT sample, CASE WHEN taxid IN (3001, 3002) THEN 'host' ELSE coalesce(truth_group, 'false_positive') END AS class, sum(reads)::BIGINT AS reads FROM counts LEFT JOIN truth USING (taxid) GROUP BY ALL) SELECT *, reads::DOUBLE / sum(reads) OVER (PARTITION BY sample) AS share FROM s", "counts truth")
def composition_with_fp(spark, d):
    return evaluate.composition_with_fp(view(spark, d, "counts"), view(spark, d, "truth"), [3001, 3002])


@query("WITH s AS (SELECT sample, coalesce(truth_group, 'false_positive') AS class, sum(reads)::BIGINT AS reads FROM counts LEFT JOIN truth USING (taxid) WHERE taxid NOT IN (3001, 3002) GROUP BY ALL) SELECT *, reads::DOUBLE / sum(reads) OVER (PARTITION BY sample) AS share FROM s", "counts truth")
def absolute_composition(spark, d):
    return evaluate.composition_with_fp(view(spark, d, "counts"), view(spark, d, "truth"), [3001, 3002], drop_host=True)


@query(f"WITH {_SHARES}, p AS (SELECT * FROM shares WHERE share > 0) SELECT sample, round(CASE WHEN count(*) > 1 THEN -sum(share * ln(share)) / ln(count(*)) ELSE 0 END, 9) AS uniformity_entropy, round(var_pop(share), 9) AS uniformity_var FROM p GROUP BY sample", "counts truth lengths")
def abundance_uniformity(spark, d):
    return rnd(evaluate.abundance_uniformity(shares_of(spark, d)), "uniformity_entropy", "uniformity_var")


@query(f"WITH {_CALLS},{SCORES} SELECT CASE WHEN sample[2:]::INT < 12 THEN 'a' ELSE 'b' END AS regime, round(avg(f1), 9) AS f1_mean, round(stddev_samp(f1), 9) AS f1_sd, round(avg(fp), 9) AS fp_mean, round(stddev_samp(fp), 9) AS fp_sd FROM scored GROUP BY 1", "counts truth")
def metric_summary(spark, d):
    rows = scores_of(spark, d).withColumn("regime", F.expr("CASE WHEN CAST(substring(sample, 2) AS INT) < 12 THEN 'a' ELSE 'b' END"))
    return rnd(evaluate.metric_summary(rows, ("regime",)), "f1_mean", "f1_sd", "fp_mean", "fp_sd")


@query(f"WITH {_CALLS},{SCORES}, t AS (SELECT concat('tool', CAST(sample[2:]::INT % 3 AS STRING)) AS tool, sample, precision, recall, f1 FROM scored) SELECT tool, sample, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM t UNION ALL SELECT tool, 'MEAN', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9) FROM t GROUP BY tool", "counts truth")
def tool_comparison(spark, d):
    rows = scores_of(spark, d).withColumn("tool", F.expr("concat('tool', CAST(substring(sample, 2) AS INT) % 3)"))
    return rnd(evaluate.tool_comparison(rows), "precision", "recall", "f1")


_GRID = "SELECT concat(CAST(i AS STRING), '/', CAST(l AS STRING)) AS cell, i AS min_identity, l AS min_length FROM (SELECT unnest([0.9, 0.93, 0.96]::DOUBLE[]) AS i) CROSS JOIN (SELECT unnest([50, 70]) AS l)"


@query(f"WITH grid AS ({_GRID}), ps AS (SELECT cell, sample, taxid, count(*) AS n FROM (SELECT cell, sample, taxid, row_number() OVER (PARTITION BY cell, sample, query ORDER BY bits DESC, fident DESC, taxid) AS k FROM hits JOIN grid ON fident >= min_identity AND alnlen >= min_length) WHERE k = 1 GROUP BY ALL), tot AS (SELECT cell, sample, sum(n)::BIGINT AS reads, count(*) FILTER (n >= 3) AS taxa FROM ps GROUP BY ALL), sc AS (SELECT cell, sample, count(DISTINCT truth_group) AS tp, count(*) FILTER (truth_group IS NULL) AS fp, (SELECT count(DISTINCT truth_group) FROM truth) AS g FROM ps LEFT JOIN truth USING (taxid) WHERE n >= 3 GROUP BY ALL), s2 AS (SELECT cell, sample, tp, fp, g - tp AS fn, tp::DOUBLE / (tp + fp) AS precision, tp::DOUBLE / g AS recall FROM sc WHERE tp + fp > 0) SELECT cell, sample, reads, taxa, tp, fp, fn, precision, recall, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM tot LEFT JOIN s2 USING (cell, sample)", "hits truth")
def parameter_grid(spark, d):
    grid = spark.createDataFrame([(f"{i}/{length}", i, length) for i in (0.9, 0.93, 0.96) for length in (50, 70)], "cell string, min_identity double, min_length int")
    grid = grid.withColumn("cell", F.concat(F.col("min_identity").cast("string"), F.lit("/"), F.col("min_length").cast("string")))
    return evaluate.parameter_grid(view(spark, d, "hits"), grid, view(spark, d, "truth"))


_REGIMES = "WITH" + MASKED + ", rg AS (SELECT 'none' AS regime, * FROM hm UNION ALL SELECT 'reference', * FROM hm WHERE target NOT IN (SELECT target FROM mask) UNION ALL SELECT 'coordinate', * FROM hm WHERE NOT is_masked), bs AS (SELECT regime, sample, taxid, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY regime, sample, query ORDER BY bits DESC, fident DESC, taxid) AS k FROM rg) WHERE k = 1 GROUP BY ALL), sc AS (SELECT regime, sample, count(DISTINCT truth_group) AS tp, count(*) FILTER (truth_group IS NULL) AS fp, (SELECT count(DISTINCT truth_group) FROM truth) AS g FROM bs LEFT JOIN truth USING (taxid) WHERE n >= 3 GROUP BY ALL), s2 AS (SELECT regime, sample, tp, fp, g - tp AS fn, tp::DOUBLE / (tp + fp) AS precision, tp::DOUBLE / g AS recall FROM sc) SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM s2"


@query(_REGIMES, "hits mask truth")
def masking_regimes(spark, d):
    h, m = view(spark, d, "hits"), view(spark, d, "mask")
    regimes = {"none": h, "reference": hits.split_by_target(h, m)[1], "coordinate": hits.drop_all_masked_reads(h, m)}
    return evaluate.masking_regimes(regimes, view(spark, d, "truth"))


@query("WITH st AS (SELECT DISTINCT target, CASE WHEN target LIKE '%_0' THEN 'A' ELSE 'B' END AS s FROM hits), r AS (SELECT sample, taxid, strand, query, bool_or(s = 'A') AS a, bool_or(s = 'B') AS b FROM hits JOIN st USING (target) GROUP BY ALL), t AS (SELECT h.sample, h.taxid, h.strand, string_agg(DISTINCT h.target, ',' ORDER BY h.target) AS x FROM hits h JOIN r ON r.sample = h.sample AND r.taxid = h.taxid AND r.strand = h.strand AND r.query = h.query AND a AND b GROUP BY ALL) SELECT sample, taxid, strand, count(*) FILTER (a) AS in_a, count(*) FILTER (b) AS in_b, count(*) FILTER (a AND b) AS in_both, coalesce(any_value(x), '') AS common_targets FROM r LEFT JOIN t USING (sample, taxid, strand) GROUP BY sample, taxid, strand", "hits")
def reference_set_overlap(spark, d):
    h = view(spark, d, "hits")
    sets = h.select("target").distinct().withColumn("ref_set", F.when(F.col("target").endswith("_0"), "A").otherwise("B"))
    return evaluate.reference_set_overlap(h, sets).withColumn("common_targets", F.array_join("common_targets", ","))


# --- EM

_E0 = "cd AS (SELECT sample, query, taxid AS species, max(bits) AS score FROM hits GROUP BY ALL), sp AS (SELECT sample, species, greatest(coalesce(length, 0), 1000)::DOUBLE AS len, 1.0::DOUBLE / count(*) OVER (PARTITION BY sample) AS a FROM (SELECT DISTINCT sample, species FROM cd) LEFT JOIN lengths ON taxid = species)"


def _round_sql(k):
    return f""",
p{k} AS (SELECT c.sample, c.query, c.species, CASE WHEN count(*) OVER w = 1 THEN 1.0 WHEN sum(a * score) OVER w > 0 THEN a * score / sum(a * score) OVER w ELSE 1.0 / count(*) OVER w END AS post FROM cd c JOIN {'sp' if k == 1 else f'r{k - 1}'} s ON s.sample = c.sample AND s.species = c.species WINDOW w AS (PARTITION BY c.sample, c.query)),
r{k} AS (SELECT sample, species, len, c / len / sum(c / len) OVER (PARTITION BY sample) AS a FROM (SELECT sample, species, sum(post) AS c FROM p{k} GROUP BY ALL) JOIN (SELECT sample, species, len FROM sp) USING (sample, species))"""


def em_candidates(spark, d):
    return view(spark, d, "hits").groupBy("sample", "query", F.col("taxid").alias("species")).agg(F.max("bits").alias("score"))


@query(f"WITH {_E0}{''.join(_round_sql(k) for k in (1, 2, 3, 4))} SELECT sample, species, round(a, 8) AS a FROM r4", "hits lengths")
def em_abundance_4_rounds(spark, d):
    return rnd(em.em_abundance(em_candidates(spark, d), view(spark, d, "lengths").withColumnRenamed("taxid", "species"), rounds=4, tolerance=0.0), "a", digits=8)


@query()
def em_assign(spark, d):
    c = em_candidates(spark, d)
    share = em.em_abundance(c, view(spark, d, "lengths").withColumnRenamed("taxid", "species"))
    return rnd(em.em_assign(c, share), "posterior", digits=6)


# --- the detection model


def labelled_summary(spark, d):
    """Features of each detected taxon, labelled 1 if the truth has its species."""
    lineage = taxonomy.lineages(view(spark, d, "taxonomy"))
    summary = q_cover.coverage.coverage_summary(q_cover.strains_of(spark, d)[0])
    rows = assign.attach_pair_support(summary, assign.pair_support(view(spark, d, "hits"), lineage))
    true = view(spark, d, "truth").select(F.col("taxid").alias("species"), F.lit(1).alias("label")).distinct()
    rows = taxonomy.attach_rank(rows, lineage, "species", "taxon", "species").join(true, "species", "left").fillna(0, ["label"]).drop("species")
    return ml.ml_features(rows)


@query()
def tp_fp_model(spark, d):
    rows = stage(labelled_summary(spark, d))
    model, _ = ml.train_tp_fp_model(rows)
    return rnd(ml.score_tp_fp(model, rows).select("sample", "taxon", "tp_probability", "accepted"), "tp_probability", digits=6)


# --- reads

_WORDS = "wd AS (SELECT sample, read_id, list_filter(string_split_regex(seq, '\\s+'), lambda x: true) AS w FROM reads), rs AS (SELECT DISTINCT sample, read_id, list_aggregate(w[i:i+4], 'string_agg', ' ') AS km FROM (SELECT sample, read_id, w, unnest(range(1, len(w) - 3)) AS i FROM wd WHERE len(w) >= 5))"
_HW = "hw AS (SELECT string_split_regex(seq, '\\s+') AS w, target FROM host_texts), hs AS (SELECT DISTINCT list_aggregate(w[i:i+4], 'string_agg', ' ') AS km FROM (SELECT w, unnest(range(1, len(w) - 3)) AS i FROM hw WHERE len(w) >= 5))"


@query(f"WITH {_WORDS},{_HW} SELECT sample, read_id, count(*) AS host_kmers FROM rs JOIN hs USING (km) GROUP BY ALL HAVING count(*) >= 2", "reads host_texts")
def kmer_screen(spark, d):
    return reads.remove_host_reads(view(spark, d, "reads"), view(spark, d, "host_texts"), 5, 2, " ")[1]


@query("WITH a AS (SELECT sample, read_id, i - 1 AS qpos, list_aggregate(w[i:i+4], 'string_agg', ' ') AS km FROM (SELECT sample, read_id, w, unnest(range(1, len(w) - 3)) AS i FROM (SELECT sample, read_id, string_split_regex(seq, '\\s+') AS w FROM reads) WHERE len(w) >= 5)), b AS (SELECT target, i - 1 AS tpos, list_aggregate(w[i:i+4], 'string_agg', ' ') AS km FROM (SELECT target, w, unnest(range(1, len(w) - 3)) AS i FROM (SELECT target, string_split_regex(seq, '\\s+') AS w FROM host_texts) WHERE len(w) >= 5)) SELECT sample, read_id, target, (tpos - qpos)::INT AS diagonal, count(*) AS seeds, min(qpos)::INT AS qstart, max(qpos)::INT AS qend FROM a JOIN b USING (km) GROUP BY 1, 2, 3, 4 HAVING count(*) >= 3", "reads host_texts")
def kmer_seed(spark, d):
    return reads.kmer_seed_search(view(spark, d, "reads"), view(spark, d, "host_texts"), 5, 3, " ")


def _minimizer_sql(rows, keys, k, w):
    """mz_<rows>: keys, pos, kmer, forward of the minimizers of the view's sequences."""
    value = lambda x: "+".join(f"(strpos('ACGT', substr({x}, {i + 1}, 1)) - 1) * {4 ** (k - 1 - i)}" for i in range(k))
    return f"""
k_{rows} AS (SELECT *, unnest(range(length(seq) - {k} + 1)) AS pos FROM {rows}),
v_{rows} AS (SELECT {keys}, length(seq) - {k} AS last, pos, CASE WHEN NOT contains(km, 'N') THEN {value("km")} END AS f, CASE WHEN NOT contains(km, 'N') THEN {value("rc")} END AS r
  FROM (SELECT *, substr(seq, pos + 1, {k}) AS km, translate(reverse(substr(seq, pos + 1, {k})), 'ACGT', 'TGCA') AS rc FROM k_{rows})),
o_{rows} AS (SELECT *, least(f, r) AS kmer, xor(least(f, r)::BIGINT, {MASK & (4 ** k - 1)}) AS o FROM v_{rows}),
w_{rows} AS (SELECT *, CASE WHEN pos <= greatest(last - {w} + 1, 0) THEN min(o) OVER (PARTITION BY {keys} ORDER BY pos ROWS BETWEEN CURRENT ROW AND {w - 1} FOLLOWING) END AS m FROM o_{rows}),
mz_{rows} AS (SELECT {keys}, pos, kmer, f = kmer AS forward FROM (SELECT *, max(m) OVER (PARTITION BY {keys} ORDER BY pos ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW) AS top FROM w_{rows}) WHERE o = top)"""


@query(f"WITH {_minimizer_sql('dna_reads', 'sample, read_id', 15, 19)},{_minimizer_sql('host_seqs', 'target', 15, 19)} SELECT sample, read_id, count(DISTINCT kmer) AS host_kmers FROM mz_dna_reads JOIN (SELECT DISTINCT kmer FROM mz_host_seqs) USING (kmer) GROUP BY ALL HAVING count(DISTINCT kmer) >= 2", "dna_reads host_seqs")
def host_screen(spark, d):
    return reads.remove_host_reads(view(spark, d, "dna_reads"), view(spark, d, "host_seqs"), 15, window=19)[1]


@query(f"WITH {_minimizer_sql('dna_reads', 'sample, read_id', 15, 19)},{_minimizer_sql('host_seqs', 'target', 15, 19)}, gone AS (SELECT sample, read_id FROM mz_dna_reads JOIN (SELECT DISTINCT kmer FROM mz_host_seqs) USING (kmer) GROUP BY ALL HAVING count(DISTINCT kmer) >= 2) SELECT sample, read_id, seq FROM dna_reads ANTI JOIN gone USING (sample, read_id)", "dna_reads host_seqs")
def host_free_reads(spark, d):
    return reads.remove_host_reads(view(spark, d, "dna_reads"), view(spark, d, "host_seqs"), 15, window=19)[0].select("sample", "read_id", "seq")


_SEEDS = _minimizer_sql("dna_reads", "sample, read_id", 11, 5) + "," + _minimizer_sql("host_seqs", "target", 11, 5) + """,
sd AS (SELECT q.sample, q.read_id, 80 AS qlen, t.target, 256 AS tlen, CASE WHEN q.forward = t.forward THEN '+' ELSE '-' END AS strand, CASE WHEN q.forward = t.forward THEN q.pos ELSE 80 - 11 - q.pos END AS qpos, t.pos AS tpos FROM mz_dna_reads q JOIN mz_host_seqs t USING (kmer)),
bd AS (SELECT *, sum(fresh) OVER (PARTITION BY sample, read_id, target, strand ORDER BY diagonal) AS band FROM (SELECT *, coalesce((diagonal - lag(diagonal) OVER (PARTITION BY sample, read_id, target, strand ORDER BY diagonal) > 16)::INT, 0) AS fresh FROM (SELECT *, tpos - qpos AS diagonal FROM sd)))"""


@query(f"WITH {_SEEDS} SELECT sample, read_id, target, strand, band::BIGINT AS band, count(*) AS seeds, min(diagonal) AS least, max(diagonal) AS most FROM bd GROUP BY ALL", "dna_reads host_seqs")
def seed_bands(spark, d):
    rows = reads.in_bands(reads.seeds(view(spark, d, "dna_reads"), view(spark, d, "host_seqs"), 11))
    return rows.groupBy("sample", "read_id", "target", "strand", "band").agg(F.count("*").alias("seeds"), F.min("diagonal").alias("least"), F.max("diagonal").alias("most"))


@query(f"""WITH {_SEEDS}, fi AS (SELECT sample, read_id, target, strand, band, qlen, tlen, qpos, min(tpos) AS tpos FROM bd GROUP BY ALL),
ch AS (SELECT *, qpos - lag(qpos) OVER w AS step FROM (SELECT *, max(tpos) OVER (PARTITION BY sample, read_id, target, strand, band ORDER BY qpos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM fi) WHERE far IS NULL OR tpos > far WINDOW w AS (PARTITION BY sample, read_id, target, strand, band ORDER BY qpos)),
su AS (SELECT sample, read_id, target, strand, band, qlen, tlen, count(*) AS seeds, sum(least(11, coalesce(step, 11))) AS bases, min(qpos) AS q0, max(qpos) + 11 AS q1, min(tpos) AS t0, max(tpos) + 11 AS t1 FROM ch GROUP BY ALL HAVING count(*) >= 2)
SELECT sample, read_id AS query, target, strand, round(bases::DOUBLE / greatest(q1 - q0, t1 - t0), 9) AS fident, greatest(q1 - q0, t1 - t0)::INT AS alnlen, (CASE WHEN strand = '+' THEN q0 + 1 ELSE qlen - q1 + 1 END)::INT AS qstart, (CASE WHEN strand = '+' THEN q1 ELSE qlen - q0 END)::INT AS qend, (t0 + 1)::INT AS tstart, t1::INT AS tend, bases::DOUBLE AS bits, seeds, row_number() OVER (PARTITION BY sample, read_id ORDER BY bases DESC, target, strand, t0, band)::INT AS place FROM su""", "dna_reads host_seqs")
def chained_hits(spark, d):
    return rnd(reads.chained_hits(view(spark, d, "dna_reads"), view(spark, d, "host_seqs"), 11), "fident").drop("evalue", "qlen", "tlen", "taxid")


_FQ = "fq AS (SELECT concat('s', CAST(l_orderkey % 4 AS STRING)) AS sample, CAST(1 + l_linenumber % 2 AS INT) AS mate, CAST(l_orderkey AS STRING) AS read_id, concat(CASE WHEN l_partkey % 3 = 0 THEN 'ACGTACGT' ELSE '' END, translate(CAST(l_partkey * 7919 + l_orderkey AS STRING), '0123456789', 'ACGTACGTAC'), CASE WHEN l_suppkey % 4 = 0 THEN 'GGGGGGGGGGGG' WHEN l_suppkey % 4 = 1 THEN 'TTTTTTTTTTT' ELSE 'ACGTAC' END) AS seq FROM lineitem)"


def fastq(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    seq = "concat(CASE WHEN l_partkey % 3 = 0 THEN 'ACGTACGT' ELSE '' END, translate(CAST(l_partkey * 7919 + l_orderkey AS STRING), '0123456789', 'ACGTACGTAC'), CASE WHEN l_suppkey % 4 = 0 THEN 'GGGGGGGGGGGG' WHEN l_suppkey % 4 = 1 THEN 'TTTTTTTTTTT' ELSE 'ACGTAC' END)"
    rows = li.selectExpr("concat('s', l_orderkey % 4) AS sample", "1 + l_linenumber % 2 AS mate", "CAST(l_orderkey AS STRING) AS read_id", f"{seq} AS seq")
    return rows.withColumn("qual", F.translate("seq", "ACGT", "5?IF"))


_GC = "round(100.0 * (length(seq) - length(translate(seq, 'GC', ''))) / greatest(length(seq), 1))::INT"


@query(f"WITH {_FQ} SELECT sample, mate, kind, bin, count(*) AS n FROM (SELECT sample, mate, 'length' AS kind, length(seq)::INT AS bin FROM fq UNION ALL SELECT sample, mate, 'gc', {_GC} FROM fq UNION ALL SELECT sample, mate, 'copies', count(*)::INT FROM fq GROUP BY sample, mate, seq) GROUP BY ALL", "refs")
def read_histograms(spark, d):
    return reads.read_histograms(fastq(spark, d))


@query(f"WITH {_FQ}, t AS (SELECT sample, mate, read_id, regexp_replace(regexp_replace(seq, 'G{{10,}}$', ''), '(A{{10,}}|C{{10,}}|G{{10,}}|T{{10,}}|N{{10,}})$', '') AS seq FROM fq) SELECT sample, mate, read_id, seq, translate(seq, 'ACGT', '5?IF') AS qual FROM t WHERE length(seq) >= 8", "refs")
def trim_reads(spark, d):
    return reads.trim_tails(fastq(spark, d), min_length=8)


@query(f"WITH {_FQ}, t AS (SELECT sample, mate, read_id, regexp_replace(seq, '^(ACGT){{1,8}}', '') AS seq FROM fq) SELECT sample, mate, read_id, seq, translate(seq, 'ACGT', '5?IF') AS qual FROM t WHERE NOT EXISTS (SELECT 1 FROM t b WHERE b.sample = t.sample AND b.read_id = t.read_id AND length(b.seq) < 14)", "refs")
def trim_adapter(spark, d):
    return reads.trim_adapter(fastq(spark, d), "ACGT", min_length=14)


_EDITS = "list_min(list_filter([CASE WHEN length(cur) >= x AND levenshtein(substr(cur, 1, x), 'ACGTACGT') <= 1 THEN (levenshtein(substr(cur, 1, x), 'ACGTACGT') * 1000 + abs(x - 8)) * 1000 + 999 - x END FOR x IN [7, 8, 9]], lambda c: c IS NOT NULL))"


@query(f"""WITH {_FQ}, nb AS (SELECT *, row_number() OVER () AS id FROM fq), ro AS (SELECT id, seq AS cur, 0 AS k FROM nb UNION ALL SELECT id, substr(cur, 1 + coalesce(999 - code % 1000, 0)), k + 1 FROM (SELECT *, {_EDITS} AS code FROM ro) WHERE k < 8),
t AS (SELECT sample, mate, read_id, cur AS seq, substr(translate(seq, 'ACGT', '5?IF'), length(seq) - length(cur) + 1) AS qual FROM nb JOIN ro USING (id) WHERE k = 8)
SELECT sample, mate, read_id, seq, qual FROM t WHERE NOT EXISTS (SELECT 1 FROM t b WHERE b.sample = t.sample AND b.read_id = t.read_id AND length(b.seq) < 10)""", "refs")
def trim_adapter_edits(spark, d):
    return reads.trim_adapter(fastq(spark, d), "ACGTACGT", min_length=10, errors=1)


@query(f"WITH {_FQ}, e AS (SELECT sample, mate, (unnest(range(length(seq))))::INT AS pos, unnest(string_split(seq, '')) AS b FROM fq), q AS (SELECT *, CASE b WHEN 'A' THEN 20 WHEN 'C' THEN 30 WHEN 'G' THEN 40 ELSE 37 END AS q FROM e) SELECT sample, mate, pos, count(*) AS bases, round(avg(q), 9) AS mean_q, quantile_cont(q, 0.25)::DOUBLE AS q25, quantile_cont(q, 0.5)::DOUBLE AS q50, quantile_cont(q, 0.75)::DOUBLE AS q75, round(avg((b = 'A')::INT), 9) AS share_a, round(avg((b = 'C')::INT), 9) AS share_c, round(avg((b = 'G')::INT), 9) AS share_g, round(avg((b = 'T')::INT), 9) AS share_t, round(avg((b = 'N')::INT), 9) AS share_n FROM q GROUP BY ALL", "refs")
def quality_profile(spark, d):
    return rnd(reads.fastq_quality_profile(fastq(spark, d)), "mean_q", *[f"share_{b}" for b in "acgtn"])


@query(f"WITH {_FQ}, t AS (SELECT *, regexp_replace(regexp_replace(seq, 'G{{10,}}$', ''), '(A{{10,}}|C{{10,}}|G{{10,}}|T{{10,}}|N{{10,}})$', '') AS s2 FROM fq) SELECT sample, mate, count(*) AS reads_before, sum(length(seq))::BIGINT AS bases_before, count(*) FILTER (length(s2) >= 8) AS reads_after, coalesce(sum(length(s2)) FILTER (length(s2) >= 8), 0)::BIGINT AS bases_after FROM t GROUP BY ALL", "refs")
def trim_totals(spark, d):
    before = fastq(spark, d)
    return reads.trim_totals(before, reads.trim_tails(before, min_length=8))


@query(f"WITH {_FQ} SELECT sample, name, sum(v)::BIGINT AS value FROM (SELECT sample, 'reads' AS name, count(*) AS v FROM fq GROUP BY sample UNION ALL SELECT sample, 'bases', sum(length(seq)) FROM fq GROUP BY sample) GROUP BY ALL", "refs")
def qc_summary(spark, d):
    f = fastq(spark, d)
    return reads.qc_summary([f.groupBy("sample").agg(F.lit("reads").alias("name"), F.count("*").alias("value")).select("sample", "name", "value"), f.groupBy("sample").agg(F.lit("bases").alias("name"), F.sum(F.length("seq")).alias("value")).select("sample", "name", "value")])


@query("WITH" + BEST + " SELECT sample, taxid, count(*) AS n FROM best GROUP BY ALL", "hits")
def best_hit_counts(spark, d):
    return assign.best_hit(view(spark, d, "hits")).groupBy("sample", "taxid").agg(F.count("*").alias("n"))
