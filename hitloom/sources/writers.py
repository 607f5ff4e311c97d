"""Sinks: Parquet caches, CSV and TSV tables, per-read lines, hierarchical reports, matrices and BED."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitloom.functions.stage import own_dir, stage
from hitloom.functions.text import rank_code
from hitloom.operators.cohort import pivot_samples, running
from hitloom.operators.counts import depth_first, direct_counts


MATRIX_COLUMNS = 20_000  # taxa in one file of a matrix with samples as rows


def write_hits_cache(hits: DataFrame, path: str) -> None:
    hits.write.mode("overwrite").partitionBy("sample").parquet(path, compression="zstd")


# The order of the rows of result tables within a sample: column and whether it descends.
ORDERS = {
    "abundance": [("read_count", True), ("working_taxid", False)],
    "summary": [("total_reads", True), ("taxon", False)],
    "clades": [("depth", False), ("reads", True), ("taxid", False)],
}


def in_order(rows: DataFrame, kind: str) -> DataFrame:
    """Add line: the place of each row of a result table (abundance, summary or clades) within its sample; nulls come last."""
    order = [F.desc_nulls_last(c) if down else F.asc_nulls_last(c) for c, down in ORDERS[kind]]
    return rows.withColumn("line", F.row_number().over(Window.partitionBy("sample").orderBy(*order)))


def write_ordered(rows: DataFrame, path: str, kind: str, sep: str = "\t") -> None:
    """A result table with a folder and one file for each sample, its rows in the order of in_order()."""
    lines = in_order(rows, kind).repartition("sample").sortWithinPartitions("sample", "line")
    write_table(lines.drop("line"), path, sep, by_sample=True)


def write_table(rows: DataFrame, path: str, sep: str = "\t", by_sample: bool = False) -> None:
    """CSV or TSV with a header, also where there are no rows; by_sample gives each sample a folder."""
    flat = [F.array_join(F.col(c).cast("array<string>"), ",").alias(c) if t.startswith("array") else F.col(c) for c, t in rows.dtypes]
    writer = rows.select(flat).write.mode("overwrite")
    (writer.partitionBy("sample") if by_sample else writer).csv(path, header=True, sep=sep)


def read_lines(assigned: DataFrame, lineage: DataFrame) -> DataFrame:
    """(sample, value): C or U, read, taxid, length and lineage (`0` if unknown), by tabs."""
    paths = lineage.select(F.col("taxid").alias("lca_taxid"), F.array_join(F.col("path")["taxid"].cast("array<string>"), "|").alias("lin"))
    rows = assigned.join(paths, "lca_taxid", "left")
    kind = F.when(F.coalesce("lca_taxid", F.lit(0)) == 0, "U").otherwise("C")
    return rows.select("sample", F.concat_ws("\t", kind, "query", F.coalesce("lca_taxid", F.lit(0)).cast("string"), F.col("qlen").cast("string"), F.coalesce("lin", F.lit("0"))).alias("value"))


def report_lines(clades: DataFrame, lineage: DataFrame) -> DataFrame:
    """(sample, line, value) of the hierarchical report: percent of the top clade, clade, direct, code, taxid, indented name."""
    rows = depth_first(direct_counts(clades), lineage)
    top = rows.groupBy("sample").agg(F.max("reads").alias("top"))
    rows = rows.join(top, "sample")
    percent = F.format_string("%6.2f", 100 * F.col("reads") / F.col("top"))
    name = F.concat(F.repeat(F.lit("  "), F.coalesce("depth", F.lit(0))), F.col("name"))
    return rows.select("sample", "line", F.concat_ws("\t", percent, F.col("reads").cast("string"), F.col("direct").cast("string"), rank_code(F.col("rank")), F.col("taxid").cast("string"), name).alias("value"))


def write_lines(lines: DataFrame, path: str, order: str | None = None) -> None:
    """Text files in a folder per sample, each in order if a column is named."""
    rows = lines.repartition("sample").sortWithinPartitions("sample", order) if order else lines
    rows.select("sample", "value").write.mode("overwrite").partitionBy("sample").text(path)


def write_matrix(otu: DataFrame, path: str, samples: list[str], transpose: bool = True, sep: str = ",") -> None:
    """The sample x taxon matrix: taxa as rows, or (transposed) samples as rows.

    Transposed, more than MATRIX_COLUMNS taxa are written as several tables in folders columns_00000, columns_00001 ...
    under path, by ascending taxid; each of them has all samples. Their lines are text: a plan with a column for each taxon
    takes longer to make than the matrix. readers.read_matrix() reads either layout.
    """
    if not transpose:
        write_table(pivot_samples(otu, "taxid", samples), path, sep)
        return
    numbered = stage(running(otu.select("taxid").distinct().withColumn("one", F.lit(1)), ["taxid"], "one").select("taxid", F.floor((F.col("upto") - 1) / MATRIX_COLUMNS).alias("block")))
    found = numbered.agg(F.max("block")).first()[0]
    blocks = 0 if found is None else found + 1
    if blocks != 1:  # files of an earlier, smaller matrix or of more blocks go; without taxa there is but the header
        write_table(otu.select("sample").limit(0), path, sep)
    rows = stage(otu.select("sample", "taxid", "value"))
    zeros = rows.select("sample").distinct().crossJoin(numbered.select("taxid")).withColumn("value", F.lit(0).cast(rows.schema["value"].dataType))
    cells = rows.unionByName(zeros).groupBy("sample", "taxid").agg(F.coalesce(F.sum("value"), F.lit(0)).cast("string").alias("value")).join(numbered, "taxid")
    values = F.array_join(F.array_sort(F.collect_list(F.struct("taxid", "value")))["value"], sep)
    lines = cells.groupBy("sample", "block").agg(values.alias("values")).select("block", F.concat_ws(sep, F.to_csv(F.struct("sample"), {"sep": sep}), "values").alias("value"))
    staged = f"{own_dir(otu.sparkSession)}/matrix-{uuid.uuid4().hex}"
    lines.write.partitionBy("block").parquet(staged)
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0  # of its partition, which is a file
    for i in range(blocks):
        taxa = [str(r[0]) for r in numbered.where(F.col("block") == i).orderBy("taxid").collect()]  # MATRIX_COLUMNS at most: the header
        own = otu.sparkSession.read.parquet(staged).where(F.col("block") == i)
        line = F.when(first, F.concat(F.lit(sep.join(["sample", *taxa]) + "\n"), "value")).otherwise(F.col("value"))
        own.select(line.alias("value")).write.mode("overwrite").text(path if blocks == 1 else f"{path}/columns_{i:05d}")


def write_empty_samples(judged: DataFrame, path: str) -> None:
    judged.where("is_empty").select(F.col("sample").alias("value")).write.mode("overwrite").text(path)


def write_bed(regions: DataFrame, path: str) -> None:
    regions.write.mode("overwrite").csv(path, header=False, sep="\t")
