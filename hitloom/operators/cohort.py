"""Cohort statistics on long tables (sample, taxid, reads) and manifests (sample, group)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitloom.functions.stage import stage
from hitloom.functions.tails import chi2_upper, normal_two_sided, rank_sum_exact, t_two_sided
from hitloom.operators.distances import bray_curtis, pcoa, permanova  # noqa: F401

EXACT = 8  # values of the smaller group up to which a rank-sum test without ties is exact


def alpha_diversity(counts: DataFrame) -> DataFrame:
    """Per sample: richness, shannon, inverse_simpson, pielou (0 for one taxon or none)."""
    total = Window.partitionBy("sample")
    rows = counts.where("reads > 0").withColumn("p", F.col("reads") / F.sum("reads").over(total))
    out = rows.groupBy("sample").agg(F.count("*").alias("richness"), (-F.sum(F.col("p") * F.log("p"))).alias("shannon"), (1 / F.sum(F.col("p") * F.col("p"))).alias("inverse_simpson"))
    return out.withColumn("pielou", F.when(F.col("richness") > 1, F.col("shannon") / F.log("richness")).otherwise(0.0))


def ranked(values: DataFrame, by: tuple[str, ...], value: str = "value") -> DataFrame:
    """Add the average rank r of value within `by`, and t, the number of equal values."""
    w = Window.partitionBy(*by).orderBy(value)
    same = Window.partitionBy(*by, value)
    return values.withColumn("t", F.count("*").over(same)).withColumn("r", F.rank().over(w) + (F.col("t") - 1) / 2)


def mann_whitney(values: DataFrame, by: tuple[str, ...], first: str, second: str) -> DataFrame:
    """Per `by`: n1, n2, U of the first group, z (normal approximation with tie and continuity correction), p_value, rank_biserial.

    p_value is exact where the smaller group has EXACT values at most and none of all values is tied, else it is that of z.
    """
    rows = ranked(values.where(F.col("group").isin(first, second)), by)
    ties = F.sum(F.col("t") * F.col("t") - 1)  # a tie of t values adds t^3 - t in all
    s = rows.groupBy(*by).agg(
        F.sum((F.col("group") == first).cast("long")).alias("n1"), F.sum((F.col("group") == second).cast("long")).alias("n2"),
        F.sum(F.when(F.col("group") == first, F.col("r"))).alias("r1"), ties.alias("ties"),
    )
    return rank_sum_test(s).select(*by, "n1", "n2", "u", "z", "p_value", "rank_biserial")


def rank_sum_test(sums: DataFrame) -> DataFrame:
    """Rows with n1, n2, r1 (the first group's sum of ranks) and ties -> with u, z, p_value and rank_biserial, as mann_whitney(); rows without one of the groups go."""
    s = sums.where("n1 > 0 and n2 > 0").withColumn("u", F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2)
    n, prod = F.col("n1") + F.col("n2"), F.col("n1") * F.col("n2")
    sd = F.sqrt(prod / 12 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    gap = F.greatest(F.abs(F.col("u") - prod / 2) - 0.5, F.lit(0.0))
    s = s.withColumn("z", F.when(sd > 0, F.signum(F.col("u") - prod / 2) * gap / sd).otherwise(0.0)).withColumn("rank_biserial", 2 * F.col("u") / prod - 1)
    small = (F.least("n1", "n2") <= EXACT) & (F.col("ties") == 0)
    exact = rank_sum_exact(*(F.when(small, F.col(c)) for c in ("n1", "n2", "u")))
    near = F.when(F.col("z") == 0, 1.0).otherwise(normal_two_sided(F.col("z")))
    return s.withColumn("p_value", F.when(small, exact).otherwise(near))


def kruskal_wallis(values: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Per `by`: H over the groups with the tie correction, its degrees of freedom, p_value."""
    rows = ranked(values, by)
    g = rows.groupBy(*by, "group").agg(F.sum("r").alias("r"), F.count("*").alias("n"), F.sum(F.col("t") * F.col("t") - 1).alias("ties"))
    s = g.groupBy(*by).agg(F.sum(F.col("r") * F.col("r") / F.col("n")).alias("q"), F.sum("n").alias("n"), F.sum("ties").alias("ties"), (F.count("*") - 1).alias("df"))
    n = F.col("n")
    h = (12 / (n * (n + 1)) * F.col("q") - 3 * (n + 1)) / (1 - F.col("ties") / (n * n * n - n))
    return s.withColumn("h", h).withColumn("p_value", chi2_upper(F.col("h"), F.col("df"))).select(*by, "h", "df", "p_value")


def running(rows: DataFrame, order: list[str], weight: str) -> DataFrame:
    """Add `upto`, the sum of weight over all rows up to this one in the order, and `part`, a range of rows in that order.

    Rows are dealt out by ranges of the order, so no task gets them all; only the ranges' sums meet in one window.
    """
    parts = stage(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("part").agg(F.sum(weight).alias("own")).select("part", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("start"))
    inside = F.sum(weight).over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return parts.withColumn("upto", inside).join(starts, "part").withColumn("upto", F.col("start") + F.col("upto")).drop("start")


def bh_fdr(rows: DataFrame, p: str = "p_value", by: tuple[str, ...] = ()) -> DataFrame:
    """Add q_value (Benjamini-Hochberg) within `by`: the least p * m / rank from each p upwards, 1 at most.

    Equal p share the last place. Without `by`, the distinct p are dealt out by ranges; rows are a table first, since they
    meet their q by p, and sums made anew may differ in the last bit.
    """
    own = rows.where(F.col(p).isNotNull() & ~F.isnan(p))
    if by:
        w = Window.partitionBy(*by)
        place = F.count("*").over(w.orderBy(p).rangeBetween(Window.unboundedPreceding, 0))
        own = own.withColumn("raw_", F.col(p) * F.count("*").over(w) / place)
        least = F.min("raw_").over(w.orderBy(F.desc(p)).rangeBetween(Window.unboundedPreceding, 0))
        return own.withColumn("q_value", F.least(F.lit(1.0), least)).drop("raw_")
    own = stage(own)
    values = running(own.groupBy(F.col(p).alias("p")).agg(F.count("*").alias("n")), ["p"], "n")
    values = stage(values.join(values.agg(F.max("upto").alias("m"))).select("part", "p", (F.col("p") * F.col("m") / F.col("upto")).alias("raw")))  # one row
    later = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    above = values.groupBy("part").agg(F.min("raw").alias("own")).select("part", F.min("own").over(later).alias("above"))
    least = F.min("raw").over(Window.partitionBy("part").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, 0))
    q = values.withColumn("least", least).join(above, "part").select(F.col("p").alias(p), F.least(F.lit(1.0), "least", "above").alias("q_value"))
    return own.join(q, p)


def mean_composition(rows: DataFrame, by: tuple[str, ...], label: str, weight: str) -> DataFrame:
    """Per (by, label): sum of weight over the samples with detections in the group, renormalised to 1."""
    n = rows.groupBy(*by).agg(F.count_distinct("sample").alias("n"))
    sums = rows.groupBy(*by, label).agg(F.sum(weight).alias("w")).join(n, list(by)).withColumn("mean", F.col("w") / F.col("n"))
    return sums.withColumn("share", F.col("mean") / F.sum("mean").over(Window.partitionBy(*by))).select(*by, label, "share")


def rpk_share(reads: DataFrame, lengths: DataFrame, missing: str = "zero") -> DataFrame:
    """Share of reads per kilobase within the sample; a taxon without a length counts its reads (`reads`) or nothing (`zero`)."""
    rows = reads.join(lengths, "taxid", "left")
    other = F.col("reads").cast("double") if missing == "reads" else F.lit(0.0)
    rows = rows.withColumn("rpk", F.when(F.col("length") > 0, F.col("reads") / (F.col("length") / 1000)).otherwise(other))
    total = F.sum("rpk").over(Window.partitionBy("sample"))
    return rows.withColumn("share", F.when(total > 0, F.col("rpk") / total).otherwise(0.0)).select("sample", "taxid", "reads", "rpk", "share")


def top_n_other(rows: DataFrame, label: str, value: str, n: int, by_max: bool = True) -> DataFrame:
    """Replace all labels but the n with the largest maximum (or sum) of value by Other."""
    agg = F.max(value) if by_max else F.sum(value)
    best = rows.groupBy(label).agg(agg.alias("v")).orderBy(F.desc("v"), label).limit(n).select(label, F.lit(True).alias("top"))
    return rows.join(F.broadcast(best), label, "left").withColumn(label, F.when(F.col("top"), F.col(label)).otherwise("Other")).drop("top")  # n rows


def taxa_overlap(rows: DataFrame, first: str, second: str) -> DataFrame:
    """One row: taxa found in the first group only, in both, in the second only."""
    flags = rows.where("reads > 0").groupBy("taxid").agg(F.bool_or(F.col("group") == first).alias("a"), F.bool_or(F.col("group") == second).alias("b"))
    return flags.agg(F.count_if(F.expr("a and not b")).alias("first_only"), F.count_if(F.expr("a and b")).alias("shared"), F.count_if(F.expr("b and not a")).alias("second_only"))


def zero_fill_manifest(manifest: DataFrame, detections: DataFrame, columns: list[str]) -> DataFrame:
    return manifest.join(detections, "sample", "left").fillna(0, columns)


def kind_split(rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Reads and taxa of phages and others per `by`, and their fractions; rows carry is_phage."""
    p = F.col("is_phage")
    out = rows.groupBy(*by).agg(
        F.sum(F.when(p, F.col("reads")).otherwise(0)).alias("phage_reads"), F.sum(F.when(p, 0).otherwise(F.col("reads"))).alias("other_reads"),
        F.count_distinct(F.when(p, F.col("taxid"))).alias("phage_taxa"), F.count_distinct(F.when(~p, F.col("taxid"))).alias("other_taxa"),
    )
    return out.withColumn("phage_fraction", F.try_divide("phage_reads", F.col("phage_reads") + F.col("other_reads")))


def sample_layout(totals: DataFrame, gap: int = 2) -> DataFrame:
    """(cohort, group, sample, total) with place: samples of a group by total descending, groups in order, `gap` places between."""
    inside = F.row_number().over(Window.partitionBy("cohort", "group").orderBy(F.desc("total"), "sample"))
    sizes = totals.groupBy("cohort", "group").agg(F.count("*").alias("n"))
    before = Window.partitionBy("cohort").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("cohort", "group", F.coalesce(F.sum(F.col("n") + gap).over(before), F.lit(0)).alias("start"))
    return totals.withColumn("k", inside).join(starts, ["cohort", "group"]).withColumn("place", F.col("start") + F.col("k") - 1).drop("k", "start")


def even_representatives(sizes: DataFrame, n: int) -> DataFrame:
    """n samples evenly spaced by size: sizes (sample, size) -> those at rounded equal steps from least to largest."""
    rows = running(sizes.withColumn("one", F.lit(1)), ["size", "sample"], "one")
    count = sizes.count()
    places = sorted({(i * (count - 1) + (n - 1) // 2) // (n - 1) for i in range(n)}) if n > 1 and count > n else list(range(min(n, count)))
    return rows.where((F.col("upto") - 1).isin(places)).select(sizes.columns)


def genome_type_fractions(rows: DataFrame) -> DataFrame:
    """(sample, genome_type, reads) -> fraction of the sample's reads."""
    s = rows.groupBy("sample", "genome_type").agg(F.sum("reads").alias("reads"))
    return s.withColumn("fraction", F.col("reads") / F.sum("reads").over(Window.partitionBy("sample")))


def rna_capture(fractions: DataFrame) -> DataFrame:
    """Per sample: the share of ssRNA and dsRNA."""
    return fractions.groupBy("sample").agg(F.sum(F.when(F.col("genome_type").isin("ssRNA", "dsRNA"), F.col("fraction")).otherwise(0.0)).alias("rna_share"))


def depth_richness(rows: DataFrame) -> DataFrame:
    return rows.where("reads > 0").groupBy("sample").agg(F.count_distinct("taxid").alias("n_species"), F.sum("reads").alias("reads"))


def feature_matrix(rows: DataFrame, manifest: DataFrame, feature: str, value: str) -> DataFrame:
    """(sample, feature, value) for every sample of the manifest and every feature that isn't zero everywhere, zero-filled."""
    sums = rows.groupBy("sample", feature).agg(F.sum(value).alias("value"))
    live = sums.groupBy(feature).agg(F.sum(F.abs("value")).alias("t")).where("t > 0").select(feature)
    grid = manifest.select("sample").crossJoin(live)  # the matrix itself
    return grid.join(sums, ["sample", feature], "left").fillna(0, ["value"])


def pivot_samples(long: DataFrame, row: str, samples: list[str], value: str = "value") -> DataFrame:
    """The wide matrix of a given list of samples, zeros filled."""
    return long.groupBy(row).pivot("sample", samples).agg(F.sum(value)).fillna(0)


def shared_and_specific(rows: DataFrame, least_tools: int, top: int, per_tool: int) -> DataFrame:
    """(tool, taxid, reads) -> taxa as `shared` (found by enough tools; the first `top` by reads) or `specific` (the first of each tool's others)."""
    t = rows.groupBy("taxid").agg(F.count_distinct("tool").alias("tools"), F.sum("reads").alias("all"))
    shared = t.where(F.col("tools") >= least_tools)
    best = shared.orderBy(F.desc("all"), "taxid").limit(top).select("taxid", F.lit("shared").alias("kind"), F.lit(None).cast("string").alias("tool"), F.col("all").alias("reads"))
    others = rows.join(shared.select("taxid"), "taxid", "left_anti").groupBy("tool", "taxid").agg(F.sum("reads").alias("reads"))
    w = Window.partitionBy("tool").orderBy(F.desc("reads"), "taxid")
    own = others.withColumn("k", F.row_number().over(w)).where(F.col("k") <= per_tool).select("taxid", F.lit("specific").alias("kind"), "tool", "reads")
    return best.unionByName(own)


def group_ellipse(points: DataFrame) -> DataFrame:
    """Mean, variances and covariance of (axis1, axis2) per group."""
    return points.groupBy("group").agg(
        F.avg("axis1").alias("mean1"), F.avg("axis2").alias("mean2"), F.var_samp("axis1").alias("var1"), F.var_samp("axis2").alias("var2"), F.covar_samp("axis1", "axis2").alias("cov"), F.count("*").alias("n")
    )


def differential_abundance(matrix: DataFrame, groups: DataFrame, case: str, min_prevalence: float = 0.1) -> DataFrame:
    """Per feature: slope of log2 of the total-sum-scaled value on the case group, its t and p_value, q_value.

    Zeros take half the least positive share of the feature. With one two-valued predictor, the least-squares slope is the
    difference of the groups' means.
    """
    total = Window.partitionBy("sample")
    share = F.coalesce(F.try_divide("value", F.sum("value").over(total)), F.lit(0.0))
    rows = matrix.withColumn("share", share).join(groups.select("sample", (F.col("group") == case).cast("int").alias("x")), "sample")
    f = Window.partitionBy("feature")
    rows = rows.withColumn("prevalence", F.avg((F.col("value") > 0).cast("double")).over(f)).withColumn("least", F.min(F.when(F.col("share") > 0, F.col("share"))).over(f)).where(F.col("prevalence") >= min_prevalence)
    rows = rows.withColumn("y", F.log2(F.when(F.col("share") > 0, F.col("share")).otherwise(F.col("least") / 2)))
    s = rows.groupBy("feature").agg(*[a for g in (0, 1) for a in (F.count_if(F.col("x") == g).alias(f"n{g}"), F.avg(F.when(F.col("x") == g, F.col("y"))).alias(f"m{g}"), F.var_pop(F.when(F.col("x") == g, F.col("y"))).alias(f"v{g}"))], F.first("prevalence").alias("prevalence"))
    df = F.col("n0") + F.col("n1") - 2
    se = F.sqrt(F.try_divide(F.col("v0") * F.col("n0") + F.col("v1") * F.col("n1"), df) * (1 / F.col("n0") + 1 / F.col("n1")))
    s = s.where("n0 > 0 and n1 > 0").withColumn("slope", F.col("m1") - F.col("m0")).withColumn("t", F.when(se > 0, F.col("slope") / se)).withColumn("p_value", t_two_sided(F.col("t"), df.cast("double")))
    return bh_fdr(s.select("feature", "prevalence", "slope", "t", "p_value"))


def differential_prevalence(matrix: DataFrame, groups: DataFrame, case: str) -> DataFrame:
    """Per feature: 2 x 2 counts of presence, log odds ratio (with 0.5 added to each), its Wald z, p_value and q_value."""
    rows = matrix.join(groups, "sample").withColumn("there", F.col("value") > 0).withColumn("in_case", F.col("group") == case)
    s = rows.groupBy("feature").agg(F.count_if(F.expr("in_case and there")).alias("a"), F.count_if(F.expr("in_case and not there")).alias("b"), F.count_if(F.expr("not in_case and there")).alias("c"), F.count_if(F.expr("not in_case and not there")).alias("d"))
    h = {k: F.col(k) + 0.5 for k in "abcd"}
    s = s.withColumn("log_odds", F.log(h["a"] * h["d"] / (h["b"] * h["c"]))).withColumn("z", F.col("log_odds") / F.sqrt(1 / h["a"] + 1 / h["b"] + 1 / h["c"] + 1 / h["d"]))
    return bh_fdr(s.withColumn("p_value", normal_two_sided(F.col("z"))))


def _gamma(batches: Iterator[pa.RecordBatch], instances: int) -> Iterator[pa.RecordBatch]:
    """(sample, feature, value, key) -> (sample, feature, logs): the logarithms of gamma draws, one for each instance, from the key's own stream."""
    for batch in batches:
        logs = [
            np.log(np.maximum(np.random.Generator(np.random.Philox(key=key & (1 << 64) - 1)).gamma(value + 0.5, size=instances), 1e-300))
            for value, key in zip(batch.column("value").to_pylist(), batch.column("key").to_pylist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([batch.column("sample"), batch.column("feature"), pa.array(logs, pa.list_(pa.float64()))], ["sample", "feature", "logs"])


def _log_sums(batches: Iterator[pa.RecordBatch], instances: int) -> Iterator[pa.RecordBatch]:
    """The draws of _gamma() summed up: for each batch (sample, n, sums), an array of a sum for each instance."""
    for batch in _gamma(batches, instances):
        rows = batch.column("logs").flatten().to_numpy().reshape(-1, instances)
        samples = batch.column("sample").dictionary_encode()
        of = samples.indices.fill_null(len(samples.dictionary)).to_numpy()
        found = np.unique(of)
        sums = [rows[of == i].sum(0) for i in found]
        names = [samples.dictionary[i].as_py() if i < len(samples.dictionary) else None for i in found.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(names, batch.schema.field("sample").type), pa.array(np.bincount(of)[found]), pa.array(sums, pa.list_(pa.float64()))], ["sample", "n", "sums"])


def _cells(matrix: DataFrame, seed: int) -> DataFrame:
    cells = matrix.select("sample", F.col("feature").cast("string").alias("feature"), F.col("value").cast("double").alias("value"))
    return cells.withColumn("key", F.xxhash64(F.lit(seed), "sample", "feature"))


def _logs(cells: DataFrame, instances: int) -> DataFrame:
    return cells.mapInArrow(partial(_gamma, instances=instances), f"sample {cells.schema['sample'].dataType.simpleString()}, feature string, logs array<double>")


def clr_draws(matrix: DataFrame, instances: int = 128, seed: int = 0) -> DataFrame:
    """sample, feature, instance, clr: centred log ratios of Dirichlet draws with the values plus 0.5.

    A cell's numbers follow from a hash of seed, sample and feature (a counter-based generator), so they don't depend on
    how rows are dealt out, and the features of a sample needn't meet: only its means, summed up by instance, are joined to them.
    """
    rows = _logs(_cells(matrix, seed), instances).select("sample", "feature", F.posexplode("logs").alias("instance", "log"))
    means = rows.groupBy("sample", "instance").agg(F.avg("log").alias("mean"))
    return rows.join(means, ["sample", "instance"]).select("sample", "feature", "instance", (F.col("log") - F.col("mean")).alias("clr"))


def _instance_sums(table: pa.Table) -> pa.Table:
    """(sample, feature, value, key, first, means) of one feature's samples -> a row for each instance: numbers, means and variances of both groups, r1 and ties of the ranks."""
    n, means = table.num_rows, table.column("means").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
    drawn = pa.Table.from_batches(list(_gamma(table.to_batches(), means.shape[1])))
    x = drawn.column("logs").combine_chunks().flatten().to_numpy().reshape(n, -1) - means
    in_first = table.column("first").to_numpy()
    out = {"feature": pa.repeat(table.column("feature")[0], x.shape[1])}
    for k, own in (("1", x[in_first]), ("2", x[~in_first])):
        empty = np.zeros(x.shape[1])
        out["n" + k] = pa.array(np.full(x.shape[1], len(own)))
        out["m" + k] = pa.array(own.mean(0) if len(own) else empty, mask=np.full(x.shape[1], len(own) < 1))
        out["v" + k] = pa.array(own.var(0, ddof=1) if len(own) > 1 else empty, mask=np.full(x.shape[1], len(own) < 2))
    order = np.argsort(x, 0, kind="stable")
    sorted_ = np.take_along_axis(x, order, 0)
    at = np.broadcast_to(np.arange(n)[:, None], x.shape)
    fresh = np.vstack([np.ones((1, x.shape[1]), bool), sorted_[1:] != sorted_[:-1]])
    begin = np.maximum.accumulate(np.where(fresh, at, 0), 0)  # the first and the last of the values equal to this one
    last = np.vstack([fresh[1:], np.ones((1, x.shape[1]), bool)])
    end = np.minimum.accumulate(np.where(last, at, n)[::-1], 0)[::-1]
    t = (end - begin + 1).astype(float)
    out["r1"] = pa.array((((begin + end) / 2 + 1) * in_first[order]).sum(0))
    out["ties"] = pa.array((t * t - 1).sum(0))
    return pa.table(out)


def clr_effect(matrix: DataFrame, groups: DataFrame, first: str, second: str, instances: int = 128, seed: int = 0) -> DataFrame:
    """Per feature: mean over Dirichlet instances of Welch's p and of the rank-sum p, the effect size, and the q_value of Welch's.

    The draws are those of clr_draws(), but only cells are shuffled, by feature, and no row of a draw: a task draws and tests all instances
    of one feature at a time. Cells are small and their draws aren't, so they are dealt out by number, not by their size.
    """
    spark = matrix.sparkSession
    cells = _cells(matrix, seed).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "feature")
    sums = cells.mapInArrow(partial(_log_sums, instances=instances), f"sample {cells.schema['sample'].dataType.simpleString()}, n long, sums array<double>")
    means = sums.select("sample", "n", F.posexplode("sums").alias("instance", "x")).groupBy("sample", "instance").agg((F.sum("x") / F.sum("n")).alias("mean"))
    means = means.groupBy("sample").agg(F.array_sort(F.collect_list(F.struct("instance", "mean")))["mean"].alias("means"))
    of = stage(means.join(groups, "sample").where(F.col("group").isin(first, second)).select("sample", (F.col("group") == first).alias("first"), "means"))
    s = cells.join(of, "sample").groupBy("feature").applyInArrow(_instance_sums, "feature string, n1 long, m1 double, v1 double, n2 long, m2 double, v2 double, r1 double, ties double")
    a, b = F.col("v1") / F.col("n1"), F.col("v2") / F.col("n2")
    df = (a + b) * (a + b) / (a * a / (F.col("n1") - 1) + b * b / (F.col("n2") - 1))
    s = rank_sum_test(s).withColumn("welch", t_two_sided((F.col("m1") - F.col("m2")) / F.sqrt(a + b), df)).withColumn("e", (F.col("m1") - F.col("m2")) / F.sqrt((F.col("v1") + F.col("v2")) / 2))
    return bh_fdr(s.groupBy("feature").agg(F.avg("welch").alias("p_value"), F.avg("p_value").alias("p_wilcoxon"), F.avg("e").alias("effect")))


def species_long(tools: list[DataFrame]) -> DataFrame:
    """Detections (tool, sample, taxid, name, reads) of all tools, with rel_abund within (tool, sample)."""
    rows = reduce(DataFrame.unionByName, tools).groupBy("tool", "sample", "taxid", "name").agg(F.sum("reads").alias("reads"))
    total = F.sum("reads").over(Window.partitionBy("tool", "sample"))
    return rows.withColumn("rel_abund", F.when(total > 0, F.col("reads") / total).otherwise(0.0))


def richness_summary(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """(tool, sample) richness with zeros for samples without detections, as mean and median per tool."""
    tools = rows.select("tool").distinct()
    n = rows.where("reads > 0").groupBy("tool", "sample").agg(F.count_distinct("taxid").alias("n"))
    full = tools.crossJoin(manifest.select("sample")).join(n, ["tool", "sample"], "left").fillna(0, ["n"])
    return full.groupBy("tool").agg(F.avg("n").alias("mean_richness"), F.percentile("n", 0.5).alias("median_richness"), F.count("*").alias("samples"))
