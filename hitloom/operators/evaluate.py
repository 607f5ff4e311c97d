"""Accuracy against a known truth, parameter sweeps and comparisons of tools."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitloom.functions.stage import stage
from hitloom.operators.cohort import rpk_share


def score_detection(calls: DataFrame, truth: DataFrame, by: tuple[str, ...] = ("sample",)) -> DataFrame:
    """calls (by, taxid), truth (truth_group, taxid; a group is found by any of its taxids) -> tp, fp, fn, precision, recall, f1."""
    groups = truth.agg(F.count_distinct("truth_group").alias("all"))  # one row
    rows = calls.select(*by, "taxid").distinct().join(truth, "taxid", "left")
    s = rows.groupBy(*by).agg(F.count_distinct("truth_group").alias("tp"), F.count_if(F.col("truth_group").isNull()).alias("fp")).crossJoin(F.broadcast(groups))
    s = s.withColumn("fn", F.col("all") - F.col("tp")).withColumn("precision", F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(0.0))).withColumn("recall", F.coalesce(F.try_divide("tp", "all"), F.lit(0.0)))
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return s.withColumn("f1", F.coalesce(f1, F.lit(0.0))).select(*by, "tp", "fp", "fn", "precision", "recall", "f1")


def truth_shares(reads: DataFrame, truth: DataFrame, lengths: DataFrame) -> DataFrame:
    """(sample, truth_group): reads, their share of the groups' reads, and the share of reads per kilobase.

    A taxon without a length takes the longest of its group's.
    """
    top = truth.join(lengths, "taxid").groupBy("truth_group").agg(F.max("length").alias("group_length"))
    own = truth.join(lengths, "taxid", "left").join(top, "truth_group", "left").select("taxid", "truth_group", F.coalesce("length", "group_length").alias("length"))
    rows = reads.join(own, "taxid").withColumn("rpk", F.coalesce(F.try_divide(F.col("reads"), F.col("length") / 1000), F.lit(0.0)))
    s = rows.groupBy("sample", "truth_group").agg(F.sum("reads").alias("reads"), F.sum("rpk").alias("rpk"))
    w = Window.partitionBy("sample")
    return s.withColumn("raw_share", F.col("reads") / F.sum("reads").over(w)).withColumn("share", F.coalesce(F.try_divide(F.col("rpk"), F.sum("rpk").over(w)), F.lit(0.0)))


def abundance_error(shares: DataFrame, expected: DataFrame, samples: DataFrame) -> DataFrame:
    """Per sample: the mean over truth groups of |share - expected|; a group without reads has share 0."""
    grid = samples.select("sample").distinct().crossJoin(expected)  # the table itself
    rows = grid.join(shares.select("sample", "truth_group", "share"), ["sample", "truth_group"], "left").fillna(0.0, ["share"])
    return rows.groupBy("sample").agg(F.avg(F.abs(F.col("share") - F.col("expected"))).alias("vae"))


def composition_with_fp(reads: DataFrame, truth: DataFrame, host_taxids: list[int] = (), drop_host: bool = False) -> DataFrame:
    """(sample, class, reads, share): each truth group, host, and all other taxa as false positives."""
    rows = reads.join(truth, "taxid", "left").withColumn("class", F.when(F.col("taxid").isin(list(host_taxids)) if host_taxids else F.lit(False), "host").otherwise(F.coalesce("truth_group", F.lit("false_positive"))))
    if drop_host:
        rows = rows.where("class != 'host'")
    s = rows.groupBy("sample", "class").agg(F.sum("reads").alias("reads"))
    return s.withColumn("share", F.col("reads") / F.sum("reads").over(Window.partitionBy("sample")))


def parameter_grid(hits: DataFrame, grid: DataFrame, truth: DataFrame, min_reads: int = 3) -> DataFrame:
    """One job for all cells of grid (cell, min_identity, min_length): per (cell, sample) reads, taxa and detection scores.

    The grid is the caller's list of parameters and stands in the plan as a constant. Hits are dealt out by read as they are
    read, so no task sorts a file's hits, and no hit is multiplied: a read has the best hit of each cell in a column of its own.
    """
    cells = [(r["cell"], float(r["min_identity"]), float(r["min_length"])) for r in grid.select("cell", "min_identity", "min_length").collect()]
    if not cells:
        cells = [(None, float("inf"), float("inf"))]
    least = F.lit(min(c[1] for c in cells)), F.lit(min(c[2] for c in cells))
    own = hits.where((F.col("fident") >= least[0]) & (F.col("alnlen") >= least[1])).select("sample", "query", "taxid", "fident", "alnlen", "bits").repartition("sample", "query")
    hit = F.struct("bits", "fident", (-F.col("taxid")).alias("t"))
    best = own.groupBy("sample", "query").agg(*(F.max(F.when((F.col("fident") >= i) & (F.col("alnlen") >= n), hit)).alias(f"b{k}") for k, (_, i, n) in enumerate(cells)))
    rows = best.select("sample", F.inline(F.array(*(F.struct(F.lit(c).cast(grid.schema["cell"].dataType).alias("cell"), F.col(f"b{k}").alias("b")) for k, (c, _, _) in enumerate(cells)))))
    best = rows.where("b is not null").select("cell", "sample", (-F.col("b.t")).alias("taxid"))
    counts = stage(best.groupBy("cell", "sample", "taxid").agg(F.count("*").alias("n")))  # for the totals and the scores
    totals = counts.groupBy("cell", "sample").agg(F.sum("n").alias("reads"), F.count_if(F.col("n") >= min_reads).alias("taxa"))
    scores = score_detection(counts.where(F.col("n") >= min_reads), truth, ("cell", "sample"))
    return totals.join(scores, ["cell", "sample"], "left")


def masking_regimes(regimes: dict[str, DataFrame], truth: DataFrame, min_reads: int = 3) -> DataFrame:
    """Detection scores of the same reads under several masks: regimes name -> hits left."""
    from hitloom.operators.assign import best_hit

    out = None
    for name, hits in regimes.items():
        calls = best_hit(hits).groupBy("sample", "taxid").agg(F.count("*").alias("n")).where(F.col("n") >= min_reads)
        one = score_detection(calls, truth).withColumn("regime", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def metric_summary(scores: DataFrame, by: tuple[str, ...], metrics: tuple[str, ...] = ("f1", "fp")) -> DataFrame:
    """Mean and sample standard deviation of each metric per `by`."""
    return scores.groupBy(*by).agg(*[a for m in metrics for a in (F.avg(m).alias(f"{m}_mean"), F.stddev_samp(m).alias(f"{m}_sd"))])


def tool_comparison(scores: DataFrame, metrics: tuple[str, ...] = ("precision", "recall", "f1")) -> DataFrame:
    """Rows per (tool, sample), and a MEAN row per tool."""
    mean = scores.groupBy("tool").agg(*[F.avg(m).alias(m) for m in metrics]).withColumn("sample", F.lit("MEAN"))
    return scores.select("tool", "sample", *metrics).unionByName(mean.select("tool", "sample", *metrics))


def abundance_uniformity(shares: DataFrame) -> DataFrame:
    """Per sample: entropy of the truth groups' shares over its maximum, and their variance."""
    s = shares.where("share > 0").groupBy("sample").agg((-F.sum(F.col("share") * F.log("share"))).alias("h"), F.count("*").alias("n"), F.var_pop("share").alias("uniformity_var"))
    return s.select("sample", F.when(F.col("n") > 1, F.col("h") / F.log("n")).otherwise(0.0).alias("uniformity_entropy"), "uniformity_var")


def reference_set_overlap(hits: DataFrame, sets: DataFrame) -> DataFrame:
    """Per (sample, taxid, strand): distinct reads with a hit in set A, in set B, in both, and the targets of the latter.

    sets: (target, ref_set) with ref_set A or B.
    """
    reads = hits.join(sets, "target").groupBy("sample", "taxid", "strand", "query").agg(F.bool_or(F.col("ref_set") == "A").alias("a"), F.bool_or(F.col("ref_set") == "B").alias("b"), F.collect_set("target").alias("targets"))
    return reads.groupBy("sample", "taxid", "strand").agg(
        F.count_if(F.expr("a")).alias("in_a"), F.count_if(F.expr("b")).alias("in_b"), F.count_if(F.expr("a and b")).alias("in_both"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(F.expr("a and b"), F.col("targets")).otherwise(F.array().cast("array<string>")))))).alias("common_targets"),
    )


def length_normalised(reads: DataFrame, lengths: DataFrame) -> DataFrame:
    return rpk_share(reads, lengths, "reads")
