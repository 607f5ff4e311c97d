"""Abundances of multi-mapped reads by expectation-maximisation, a fixed number of relational rounds at most."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from hitloom.functions.stage import stage

READ = ("sample", "query")
EQUAL = 1e-12  # posteriors that differ by less than this part of the largest are equal: sums and products leave the last bits open


def _posterior(cands: DataFrame, share: DataFrame, read: tuple[str, ...] = READ) -> DataFrame:
    rows = cands.join(share, ["sample", "species"]).withColumn("w", F.col("a") * F.col("score"))
    own = Window.partitionBy(*read).orderBy("species").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # sums are the same in each run
    total, n = F.sum("w").over(own), F.count("*").over(own)
    return rows.withColumn("post", F.when(n == 1, 1.0).when(total > 0, F.col("w") / total).otherwise(1 / n))


def read_classes(cands: DataFrame) -> DataFrame:
    """(sample, class, reads, species, score): reads with the same candidates and scores are one class; the score of a
    read's only candidate doesn't matter, so all such reads of a species are one."""
    only = F.transform("set", lambda x: F.struct(x["species"].alias("species"), F.lit(1.0).alias("score")))
    sets = cands.groupBy(*READ).agg(F.sort_array(F.collect_list(F.struct("species", F.col("score").cast("double").alias("score")))).alias("set"))
    sets = sets.withColumn("set", F.when(F.size("set") == 1, only).otherwise(F.col("set"))).groupBy("sample", "set").agg(F.count("*").alias("reads"))
    return stage(sets.withColumn("class", F.monotonically_increasing_id()).select("sample", "class", "reads", F.inline("set")))


def em_abundance(cands: DataFrame, lengths: DataFrame, rounds: int = 20, tolerance: float = 1e-6, least_length: float = 1000.0) -> DataFrame:
    """cands (sample, query, species, score), lengths (species, length) -> (sample, species, a), shares by sample that sum to 1.

    Starts uniform; a round gives each read's weight to its species by share times score (evenly where that is 0), divides
    by the length (least_length at least) and normalises. Stops when no share moves by `tolerance` or more. Rounds work on
    classes of reads, dealt out and sorted once on the executors' disks, so a round whose shares are small shuffles no class;
    the shares of a round, a row for each sample and species, are a table in the shared folder.
    """
    classes = read_classes(cands).repartition("class").sortWithinPartitions("class", "species").persist(StorageLevel.DISK_ONLY)
    length = F.greatest(F.coalesce("length", F.lit(0.0)).cast("double"), F.lit(least_length)).alias("len")
    species = stage(classes.select("sample", "species").distinct().join(lengths, "species", "left").select("sample", "species", length))
    of_sample = Window.partitionBy("sample")
    share = species.select("sample", "species", (F.lit(1.0) / F.count("*").over(of_sample)).alias("a"))
    for _ in range(rounds):
        counts = _posterior(classes, share, ("class",)).groupBy("sample", "species").agg(F.sum(F.col("post") * F.col("reads")).alias("c"))
        new = counts.join(species, ["sample", "species"]).withColumn("r", F.col("c") / F.col("len")).withColumn("a", F.col("r") / F.sum("r").over(of_sample))
        new = stage(new.join(share.withColumnRenamed("a", "old"), ["sample", "species"]).select("sample", "species", "a", F.abs(F.col("a") - F.col("old")).alias("moved")))
        moved = new.agg(F.max("moved")).first()[0]
        share = new.drop("moved")
        if moved is None or moved < tolerance:
            break
    classes.unpersist()
    return share


def em_assign(cands: DataFrame, share: DataFrame) -> DataFrame:
    """One row per read: the species of the largest posterior (the least id of equals, see EQUAL), and the posterior."""
    own = Window.partitionBy(*READ).orderBy("species")
    whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = _posterior(cands, share).withColumns({"top": F.max("post").over(whole), "candidate_count": F.count("*").over(whole)})
    rows = rows.where(F.col("post") >= F.col("top") * (1 - EQUAL)).withColumn("place", F.row_number().over(own)).where("place = 1")
    return rows.select(*READ, "species", F.col("post").alias("posterior"), "candidate_count")
