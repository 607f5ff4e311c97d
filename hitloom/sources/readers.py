"""Readers of hit tables, masks, taxonomies, sequences and reports. Many files are one DataFrame with a sample column."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitloom.functions.stage import stage
from hitloom.functions.text import sample_name
from hitloom.operators.taxonomy import one_row_each

# The column layouts of hit tables.
HITS = "query string, target string, fident double, alnlen int, qstart int, qend int, tstart int, tend int, evalue double, bits double, qlen int, tlen int, taxid int, taxname string, taxlineage string"
LEGACY = "query string, target string, fident double, alnlen int, mismatch int, gapopen int, qstart int, qend int, tstart int, tend int, evalue double, bits double, qlen int, tlen int, taxid int"
BLAST = "query string, target string, pident double, alnlen int, mismatch int, gapopen int, qstart int, qend int, tstart int, tend int, evalue double, bits double, sgi string, saccver string, tlen int, qlen int, taxid string, taxname string, taxlineage string, qcovs double, qcovhsp double"
SUFFIXES = ["_read_classification", "_coverage_abundance", "_abundance", "_classification"]
COLUMNS = [c.split()[0] for c in HITS.split(", ")]


def _text_hits(spark: SparkSession, path: str, comment: str | None = None) -> DataFrame:
    """Lines as arrays of fields, with their file; blank lines, comments and header lines are left out."""
    lines = spark.read.text(path).select(F.col("value"), F.col("_metadata.file_path").alias("file")).where("length(trim(value)) > 0")
    if comment:
        lines = lines.where(~F.startswith("value", F.lit(comment)))
    lines = lines.select("file", F.split("value", "\t").alias("f"))
    return lines.where(~F.col("f")[0].isin("query", "qseqid"))


def _typed(rows: DataFrame, layout: str) -> DataFrame:
    fields = [x.split() for x in layout.split(", ")]
    return rows.select("file", *[F.get("f", F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(fields)])


def read_hits(spark: SparkSession, path: str, strand: str | Column | None = None) -> DataFrame:
    """Hits of the current or the legacy layout, which is told for each file: legacy if column 11 reads like a number with
    `E` or a point in any line. Identities of a file above 1 are percentages. An empty or header-only file has no rows.

    sample is the file's name without extensions and mate marks; strand is + unless given, or a Column on `file`.
    """
    rows = _text_hits(spark, path)
    kinds = rows.groupBy("file").agg(F.coalesce(F.bool_or((F.size("f") == 15) & F.col("f")[10].rlike("[eE.]") & ~F.col("f")[8].rlike("[eE.]")), F.lit(False)).alias("legacy"), F.max(F.col("f")[2].try_cast("double")).alias("top"))
    rows = rows.join(stage(kinds), "file")  # a row for each file, as a table: Spark broadcasts it by its size
    places = {name: {c.split()[0]: i for i, c in enumerate(layout.split(", "))} for name, layout in (("new", HITS), ("old", LEGACY))}
    field = lambda layout, c: F.get("f", F.lit(places[layout][c])) if c in places[layout] else F.lit(None).cast("string")
    out = rows.select("file", "top", *[F.when(F.col("legacy"), field("old", c)).otherwise(field("new", c)).try_cast(kind).alias(c) for c, kind in (x.split() for x in HITS.split(", "))])
    out = out.withColumn("fident", F.when(F.col("top") > 1, F.col("fident") / 100).otherwise(F.col("fident"))).drop("top")
    mark = strand if isinstance(strand, Column) else F.lit(strand or "+")
    return out.withColumn("sample", sample_name(F.col("file"))).withColumn("strand", mark).drop("file")


def read_hits_cached(spark: SparkSession, path: str, cache: str, strand: str | None = None) -> DataFrame:
    """Hits of a text file, from their Parquet cache where that is newer than the file; else the cache is written first."""
    if _newest(spark, path) > _newest(spark, cache):
        read_hits(spark, path, strand).write.mode("overwrite").partitionBy("sample").parquet(cache, compression="zstd")
    return spark.read.parquet(cache)


def _newest(spark: SparkSession, path: str) -> int:
    """The latest change of the files under a path, in milliseconds; -1 if it doesn't exist."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return -1
    times, files = [fs.getFileStatus(p).getModificationTime()], fs.listFiles(p, True)
    while files.hasNext():
        times.append(files.next().getModificationTime())
    return max(times)


def read_blast_hits(spark: SparkSession, path: str) -> DataFrame:
    """Hits of the 21-column layout with `#` comments; percent identity becomes a share, the first taxid counts."""
    rows = _typed(_text_hits(spark, path, "#"), BLAST)
    rows = rows.withColumns({"fident": F.col("pident") / 100, "taxid": F.split("taxid", ";")[0].try_cast("int"), "sample": sample_name(F.col("file")), "strand": F.lit("+")})
    return rows.select(*COLUMNS, "sample", "strand")


def read_paired_hits(spark: SparkSession, first: str, second: str | None = None) -> DataFrame:
    """Hits of the first mates (+) and, if given, the second (-)."""
    out = read_hits(spark, first, "+")
    return out if second is None else out.unionByName(read_hits(spark, second, "-"))


def read_mask(spark: SparkSession, path: str) -> DataFrame:
    """target, start, end from the first three columns of BED files."""
    rows = spark.read.text(path).select(F.split("value", "\t").alias("f")).where(F.size("f") >= 3)
    return rows.select(F.col("f")[0].alias("target"), F.col("f")[1].try_cast("int").alias("start"), F.col("f")[2].try_cast("int").alias("end")).where("start is not null and end is not null")


def read_taxonomy_dump(spark: SparkSession, nodes: str, names: str) -> DataFrame:
    """taxid, parent_taxid, rank, name from dump files: the least scientific name, `N/A` where there is none; one row per taxid, see one_row_each()."""
    parts = lambda path: spark.read.text(path).select(F.split(F.regexp_replace("value", r"\t\|$", ""), r"\t\|\t").alias("f"))
    n = one_row_each(parts(nodes).select(F.col("f")[0].cast("int").alias("taxid"), F.col("f")[1].cast("int").alias("parent_taxid"), F.col("f")[2].alias("rank")))
    s = parts(names).where(F.trim(F.col("f")[3]) == "scientific name").select(F.col("f")[0].cast("int").alias("taxid"), F.trim(F.col("f")[1]).alias("name")).groupBy("taxid").agg(F.min("name").alias("name"))
    return n.join(s, "taxid", "left").withColumn("name", F.coalesce("name", F.lit("N/A")))


def read_matrix(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(sample, taxid, value) of all cells of a matrix with samples as rows, in one table or in folders of columns (writers.write_matrix).

    Lines are split as text against the header of their folder; no plan has a column for each taxon.
    """
    files = spark.read.option("recursiveFileLookup", True).text(path).inputFiles()
    out = spark.createDataFrame([], "sample string, taxid string, value string")
    for folder in sorted({f.rsplit("/", 1)[0] for f in files}):
        head = [r[0] for r in spark.read.text(folder).where(F.col("value").startswith("sample" + sep)).limit(1).collect()]
        taxa = head[0].split(sep)[1:] if head else []
        if taxa:
            rows = spark.read.text(folder).where(F.col("value") != head[0])
            sample = F.from_csv("value", F.lit("sample string"), {"sep": sep, "maxColumns": str(len(taxa) + 2)})["sample"]
            values = F.slice(F.split("value", re.escape(sep)), -len(taxa), len(taxa))  # a sample's name may hold the separator
            cells = F.arrays_zip(F.split(F.lit(sep.join(taxa)), re.escape(sep)).alias("taxid"), values.alias("value"))
            lines = rows.select(sample.alias("sample"), cells.alias("cells"))  # once a line, before its cells are dealt out
            out = out.unionByName(lines.select("sample", F.inline("cells")))
    return out


def read_reference_tables(spark: SparkSession, url: str, tables: list[str], splits: dict[str, str] | None = None, rows_each: int = 1_000_000, **options: str) -> dict[str, DataFrame]:
    """Tables of a database by JDBC, or of a folder of Parquet tables.

    splits: table -> a numeric column. Such a table is read in parts of some rows_each rows, by ranges between the column's least and
    greatest value; a row without a value is in the first part.
    """
    if not url.startswith("jdbc:"):
        return {t: spark.read.parquet(f"{url}/{t}") for t in tables}

    def read(table: str, **more) -> DataFrame:
        return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options, **more).load()

    def parts(table: str) -> dict:
        column = (splits or {}).get(table)
        if column is None:
            return {}
        quoted = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column)
        n, low, high = read(f"(SELECT count(*) AS n, min({quoted}) AS low, max({quoted}) AS high FROM {table}) AS bounds").first()
        return {} if low is None else {"partitionColumn": column, "lowerBound": int(low), "upperBound": int(high) + 1, "numPartitions": max(1, -(-n // rows_each))}

    return {t: read(t, **parts(t)) for t in tables}


def read_samplesheet(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(samples, violations): samples (sample, single_end, fastq) with the runs of a sample together; violations (sample, problem)."""
    rows = spark.read.option("header", True).csv(path)
    if "fastq_2" not in rows.columns:
        rows = rows.withColumn("fastq_2", F.lit(None).cast("string"))
    ok = lambda c: F.col(c).rlike(r"^\S+\.f(ast)?q\.gz$")
    problems = F.array_compact(F.array(
        F.when(F.coalesce(F.col("sample"), F.lit("")) == "", "no name"), F.when(F.col("sample").rlike(r"\s"), "a blank in the name"),
        F.when(~F.coalesce(ok("fastq_1"), F.lit(False)), "bad fastq_1"), F.when(F.col("fastq_2").isNotNull() & ~ok("fastq_2"), "bad fastq_2"),
    ))
    bad = rows.select("sample", F.explode(problems).alias("problem"))
    samples = rows.groupBy("sample").agg(F.bool_and(F.col("fastq_2").isNull()).alias("single_end"), F.bool_or(F.col("fastq_2").isNull()).alias("any_single"), F.array_sort(F.collect_list(F.array_compact(F.array("fastq_1", "fastq_2")))).alias("fastq"))
    mixed = samples.where("any_single and not single_end").select("sample", F.lit("single and paired runs").alias("problem"))
    return samples.drop("any_single"), bad.unionByName(mixed)


def read_results(spark: SparkSession, pattern: str, sep: str = ",") -> DataFrame:
    """Result tables of many samples with a sample column: the file's name without the longest known suffix."""
    rows = spark.read.option("header", True).option("sep", sep).option("inferSchema", True).csv(pattern)
    name = F.regexp_replace(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)\.[A-Za-z]+$", 1), "(" + "|".join(SUFFIXES) + ")$", "")
    return rows.select("*", name.alias("sample"))


PIECE = 1 << 20  # bases of a record that stand in one row


BLANKS = r"[\t-\r\x{1c}-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"  # what str.split() splits at


def _fasta_pieces(batches: Iterator[pa.RecordBatch], whole: bool | None = None) -> Iterator[pa.RecordBatch]:
    """(value, file, block) in order -> pieces of records: file, block, k (the record's number in the block; 0 is what stands before
    its first header), part, header (of part 0), whole (the record has begun and ended here, in one piece), seq, length.

    Only pieces that are whole, or only the others, are given out if `whole` says so. Records within a batch are put together at once, others line by line.
    """
    names = ["file", "block", "k", "part", "header", "whole", "seq", "length"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.int64()]
    at, k, part, header, held, n = None, 0, 0, None, [], 0
    out: list[tuple] = []

    def piece(ended: bool) -> None:
        in_one = ended and k > 0 and not part
        if whole in (None, in_one):
            seq = "".join(held)
            out.append((*at, k, part, header if k and not part else None, in_one, seq, len(seq)))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    def step(value: str) -> None:
        nonlocal k, part, header, held, n
        if value.startswith(">"):
            if k or n:
                piece(ended=True)
            k, part, header, held, n = k + 1, 0, value[1:].rstrip("\r"), [], 0
            return
        held.append("".join(value.split()))
        n += len(held[-1])
        if n >= PIECE:
            piece(ended=False)
            part, held, n = part + 1, [], 0

    def short(lines: pa.Array, heads: np.ndarray) -> bool:
        """Whether the records that begin at these lines and end before the last of them are each of one piece, blanks counted."""
        return int(np.add.reduceat(pc.utf8_length(lines).to_numpy(zero_copy_only=False), heads[:-1]).max()) < PIECE

    def between(lines: pa.Array, heads: np.ndarray) -> pa.RecordBatch:
        texts = pc.if_else(pc.starts_with(lines, ">"), "", pc.replace_substring_regex(lines, BLANKS, ""))  # headers are no bases
        seqs = pc.binary_join(pa.ListArray.from_arrays(pa.array(heads, pa.int32()), texts), "")
        m = len(seqs)
        header = pc.utf8_rtrim(pc.utf8_slice_codeunits(lines.take(pa.array(heads[:-1])), 1), "\r")
        return pa.RecordBatch.from_arrays([pa.repeat(at[0], m), pa.repeat(pa.scalar(at[1], pa.int64()), m), pa.array(np.arange(k, k + m)), pa.array(np.zeros(m, np.int64)), header, pa.repeat(True, m), seqs, pc.cast(pc.utf8_length(seqs), pa.int64())], names)

    for batch in batches:
        for here, lines in _runs(batch):
            if here != at:
                if at and (k or n):
                    piece(ended=False)
                at, k, part, header, held, n = here, 0, 0, None, [], 0
            heads = np.flatnonzero(pc.starts_with(lines, ">").to_numpy(zero_copy_only=False))
            done = 0
            if len(heads) > 1:
                for value in lines[: heads[0] + 1].to_pylist():
                    step(value)
                done = int(heads[0]) + 1
                upto = lines[: heads[-1]]
                if short(upto, heads):
                    if whole is not False:
                        if out:
                            yield batch_of(out)
                            out.clear()
                        yield between(upto, heads)
                    k, part, header, held, n, done = k + len(heads) - 2, 0, None, [], 0, int(heads[-1])
                    k, header, done = k + 1, lines[done].as_py()[1:].rstrip("\r"), done + 1
            for value in lines[done:].to_pylist():
                step(value)
        if out:
            yield batch_of(out)
            out.clear()
    if at and (k or n):
        piece(ended=False)
    if out:
        yield batch_of(out)


def _fasta(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The whole records of read_fasta_pieces(), and its other pieces."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    schema = "file string, block long, k long, part long, header string, whole boolean, seq string, length long"
    full, cut = (lines.mapInArrow(partial(_fasta_pieces, whole=w), schema) for w in (True, False))
    # a block's last record is never whole: no header ends it there
    blocks = cut.groupBy("file", "block").agg(F.max(F.when((F.col("k") > 0) & (F.col("part") == 0), F.struct("block", "k"))).alias("head"))
    before = F.last("head", ignorenulls=True).over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("file", "block", before.alias("head")).where("head IS NOT NULL")
    later = cut.where("k = 0").join(blocks, ["file", "block"]).withColumn("header", F.lit(None).cast("string"))
    own = lambda rows: rows.withColumn("head", F.struct("block", "k"))
    pieces = lambda rows: rows.select("file", F.col("head").alias("record"), "header", F.struct("block", "part").alias("place"), "whole", "seq", "length")
    return pieces(own(full)), pieces(own(cut.where("k > 0")).unionByName(later))


def read_fasta_pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, record, header, place, whole, seq, length: the records of FASTA files in pieces of some PIECE bases, by lines.

    A record begins where a line begins with `>`; lines before a file's first are left out. Plain files are read in splits
    of any size: what stands before a split's first header belongs to the last header of the splits before it, so only
    one row for each split is sorted. record names a record, place orders its pieces; whole ones have no other.
    """
    whole, cut = _fasta(spark, path)
    return whole.unionByName(cut)


def fasta_lengths(spark: SparkSession, path: str) -> DataFrame:
    """header, length of each record; lengths of pieces are summed, so a record may be of any length."""
    whole, cut = _fasta(spark, path)
    joined = cut.groupBy("file", "record").agg(F.max("header").alias("header"), F.sum("length").alias("length"))
    return whole.select("header", "length").unionByName(joined.select("header", "length"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """header, seq of each record. Only records in several pieces, and the last ones of splits, are shuffled; see fasta_lengths() for lengths."""
    whole, cut = _fasta(spark, path)
    joined = cut.groupBy("file", "record").agg(F.max("header").alias("header"), F.array_sort(F.collect_list(F.struct("place", "seq"))).alias("parts"))
    return whole.select("header", "seq").unionByName(joined.select("header", F.array_join("parts.seq", "").alias("seq")))


def segments_from_fasta(fasta: DataFrame, pattern: str = r"^(\S+)\s+(.*?)\s+segment\s+([^,\s]+)", min_segments: int = 2) -> tuple[DataFrame, DataFrame]:
    """(segments, histogram): accession, virus, segment, length, genome_size of viruses with enough segments; viruses by their number of segments.

    fasta: header and seq, or header and length.
    """
    length = F.col("length") if "length" in fasta.columns else F.length("seq")
    rows = fasta.select(*[F.regexp_extract("header", pattern, i + 1).alias(c) for i, c in enumerate(("accession", "virus", "segment"))], length.alias("length")).where("virus != ''")
    of = Window.partitionBy("virus")
    rows = rows.withColumn("n", F.count("*").over(of)).withColumn("genome_size", F.sum("length").over(of)).where(F.col("n") >= min_segments)
    return rows.drop("n"), rows.select("virus", "n").distinct().groupBy("n").agg(F.count("*").alias("viruses"))


def _is_head(lines: list[str], i: int) -> bool:
    """Whether a record begins at line i: its third line is a `+`, which no sequence begins with, so no quality line passes."""
    return lines[i][:1] == "@" and i + 2 < len(lines) and lines[i + 2][:1] == "+"


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """((file, block), lines) of the stretches of a batch that lie in one block."""
    file, block, n = batch.column("file"), batch.column("block"), batch.num_rows
    if n:
        same = pc.and_(pc.equal(file[1:], file[:-1]), pc.equal(block[1:], block[:-1])).to_numpy(zero_copy_only=False)
        ends = [*(np.flatnonzero(~same) + 1).tolist(), n]
        for lo, hi in zip([0, *ends[:-1]], ends, strict=True):
            yield (file[lo].as_py(), block[lo].as_py()), batch.column("value")[lo:hi]


FASTQ_PIECE = pa.schema([("file", pa.string()), ("block", pa.int64()), ("part", pa.int32()), ("lines", pa.list_(pa.string())), ("head", pa.string()), ("seq", pa.string()), ("qual", pa.string())])


def _fastq_pieces(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """(value, file, block) in order -> whole records (head, seq, qual), or, unless `whole`, the lines before the first (part 0) and after the last (part 1) of a
    block; a block in which no record is seen to begin is all part 0, any other has a part 1, which may be empty."""
    held = pa.array([], pa.string())  # lines that aren't given out yet
    at, inside = None, False

    def part(k: int, lines: pa.Array) -> list[pa.RecordBatch]:
        if whole:
            return []
        row = [[at[0]], [at[1]], [k], [lines.to_pylist()], [None], [None], [None]]
        return [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, FASTQ_PIECE.types, strict=True)], schema=FASTQ_PIECE)]

    def records(n: int) -> list[pa.RecordBatch]:
        if not whole or not n:
            return []
        first = np.arange(0, 4 * n, 4)
        head, seq, qual = (held.take(pa.array(first + i)) for i in (0, 1, 3))
        return [pa.RecordBatch.from_arrays([pa.repeat(at[0], n), pa.repeat(pa.scalar(at[1], pa.int64()), n), pa.nulls(n, pa.int32()), pa.nulls(n, FASTQ_PIECE.types[3]), head, seq, qual], schema=FASTQ_PIECE)]

    def close() -> list[pa.RecordBatch]:
        return [] if at is None else part(1 if inside else 0, held)

    for batch in batches:
        out = []
        for here, lines in _runs(batch):
            if here != at:
                out += close()
                held, at, inside = lines.slice(0, 0), here, False
            held = pa.concat_arrays([held, lines])
            if not inside:
                texts = held.to_pylist()
                i = next((k for k in range(len(texts)) if _is_head(texts, k)), None)
                if i is None:  # no beginning in sight
                    continue
                out += part(0, held[:i])
                held, inside = held[i:], True
            n = len(held) // 4
            out += records(n)
            held = held[4 * n :]
        yield from out
    yield from close()


def read_fastq(spark: SparkSession, path: str, mate: int = 1) -> DataFrame:
    """sample, mate, read_id, seq, qual. A record is four lines; its quality may begin with @. Without records, no rows.

    Plain files are read in splits of any size: each task finds the first record of its split by itself, and only the
    lines of records that lie across two splits are shuffled and put together. Compressed files are one split each.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    schema = "file string, block long, part int, lines array<string>, head string, seq string, qual string"
    order = Window.partitionBy("file").orderBy("block", "part")
    cut = lines.mapInArrow(partial(_fastq_pieces, whole=False), schema).withColumn("k", F.sum("part").over(order))  # from the end of one block's records to the next one's
    joined = cut.groupBy("file", "k").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "part", "lines"))), lambda x: x["lines"])).alias("lines"))
    fours = joined.where(F.size("lines") >= 4).select("file", "lines", F.explode(F.sequence(F.lit(1), F.size("lines") - 3, F.lit(4))).alias("first"))
    line = lambda i: F.element_at("lines", F.col("first") + i)
    rows = lines.mapInArrow(partial(_fastq_pieces, whole=True), schema).select("file", "head", "seq", "qual")
    rows = rows.unionByName(fours.select("file", line(0).alias("head"), line(1).alias("seq"), line(3).alias("qual")))
    read_id = F.split(F.substring("head", 2, 1 << 30), " ")[0]
    return rows.select(sample_name(F.col("file")).alias("sample"), F.lit(mate).alias("mate"), read_id.alias("read_id"), "seq", "qual")


def with_parents(rows: DataFrame, by: str = "sample") -> DataFrame:
    """(by, line, depth, taxid, ...) -> parent_taxid: the taxid of the last line before, within `by`, of a lesser depth.

    A line is a parent only if the next line is deeper, and then of the depths down to that line's: these few are
    marked, and a line's parent is the last mark before it at its depth.
    """
    then = F.lead("depth").over(Window.partitionBy(by).orderBy("line"))
    marks = rows.select(by, "line", F.col("taxid").alias("parent_taxid"), "depth", then.alias("then")).where("then > depth")
    marks = marks.select(by, "line", F.explode(F.sequence(F.col("depth") + 1, "then")).alias("depth"), "parent_taxid", F.lit(True).alias("mark"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    last = F.last(F.when(F.col("mark"), F.struct("parent_taxid")), ignorenulls=True).over(Window.partitionBy(by, "depth").orderBy("line").rowsBetween(Window.unboundedPreceding, -1))
    return both.withColumn("parent_taxid", last["parent_taxid"]).where("mark IS NULL").select(*rows.columns, "parent_taxid")


def read_kreport(spark: SparkSession, path: str) -> DataFrame:
    """sample, taxid, name, rank_code, clade, direct, depth, parent_taxid; parents follow from the indentation of a file's lines in order.

    A report is one small file, read whole, so its lines' order is known.
    """
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\n")).alias("line", "value")).where("length(trim(value)) > 0")
    f = F.split("value", "\t")
    rows = text.select("file", sample_name(F.col("file")).alias("sample"), "line", f[1].cast("long").alias("clade"), f[2].cast("long").alias("direct"), F.trim(f[3]).alias("rank_code"), F.trim(f[4]).cast("long").alias("taxid"), F.trim(f[5]).alias("name"), ((F.length(f[5]) - F.length(F.ltrim(f[5]))) / 2).cast("int").alias("depth"))
    return with_parents(rows, "file").drop("file", "line")


RANKS_BY_NAME = {"superkingdom": "D", "kingdom": "K", "phylum": "P", "class": "C", "order": "O", "family": "F", "genus": "G", "species": "S"}


def relevel_report(rows: DataFrame) -> DataFrame:
    """(sample, line, rank, depth, ...) -> rank_code and depth, no line more than one level below the one before it.

    With lines numbered from 0, the depth is the number plus the least of 0 and of all depths less their numbers so far.
    Rows of the same line stand by depth, then rank, then the other columns in their order; nulls come last.
    """
    code = F.coalesce(F.create_map(*[F.lit(x) for p in RANKS_BY_NAME.items() for x in p])[F.col("rank")], F.lit("-"))
    of = Window.partitionBy("sample").orderBy("line", *(F.asc_nulls_last(c) for c in ("depth", "rank", *(c for c in rows.columns if c not in ("sample", "line", "depth", "rank")))))
    number = F.row_number().over(of) - 1
    least = F.min(F.col("depth") - F.col("number_")).over(of.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("rank_code", code).withColumn("number_", number)
    return rows.withColumn("depth", (F.col("number_") + F.least(F.lit(0), least)).cast(rows.schema["depth"].dataType)).drop("number_")


def read_lineage_report(spark: SparkSession, path: str, samples: list[str]) -> DataFrame:
    """A wide report (name lineage `rank_name|rank_name`, id lineage, one column per sample) -> sample, taxid, rank, name, value, depth."""
    wide = spark.read.option("header", True).option("sep", "\t").csv(path)
    names, ids = wide.columns[:2]
    long = wide.unpivot([names, ids], samples, "sample", "value")
    steps = F.arrays_zip(F.split(names, r"\|").alias("n"), F.split(ids, r"\|").alias("i"))
    rows = long.select("sample", F.col("value").cast("double").alias("value"), F.posexplode(steps).alias("depth", "s"))
    return rows.select("sample", F.col("s.i").try_cast("long").alias("taxid"), F.regexp_extract("s.n", "^([^_]*)_", 1).alias("rank"), F.regexp_extract("s.n", "^[^_]*_+(.*)$", 1).alias("name"), "value", "depth")


def read_tool_counts(spark: SparkSession, path: str, tool: str) -> DataFrame:
    """(tool, sample, taxid, reads) of species from a Bracken table, a ganon tree, a Metabuli report or a filtered kreport."""
    raw = spark.read.text(path).select(sample_name(F.col("_metadata.file_path")).alias("sample"), F.split("value", "\t").alias("f"))
    at = lambda i: F.get("f", F.lit(i))  # noqa: E731  lines may be shorter
    pick = {
        "bracken": (at(2) == "S", at(1), at(5)),
        "ganon": (at(0) == "species", at(1), at(7)),
        "metabuli": (F.trim(at(3)) == "species", at(4), at(1)),
        "kreport": (F.trim(at(3)) == "S", at(4), at(1)),
    }
    where, taxid, reads = pick[tool]
    rows = raw.where(where).select(F.lit(tool).alias("tool"), "sample", F.trim(taxid).try_cast("long").alias("taxid"), F.trim(reads).try_cast("double").cast("long").alias("reads"))
    return rows.where("taxid is not null").groupBy("tool", "sample", "taxid").agg(F.sum("reads").alias("reads"))


def read_blast_xml(spark: SparkSession, path: str) -> DataFrame:
    """HSPs (query, hit, alen, pid, strand, qf, qt, hf, ht) of BLAST XML, one row tag for each query.

    Files are read as text that ends at `</Iteration>`, in splits of any size, so that a task reads no whole file and holds one query at
    a time; the lines of an Iteration may be broken anywhere. Compressed files are one split each.
    """
    hsp = "struct<`Hsp_query-from`:int,`Hsp_query-to`:int,`Hsp_hit-from`:int,`Hsp_hit-to`:int,`Hsp_identity`:int,`Hsp_align-len`:int>"
    schema = f"`Iteration_query-def` string, Iteration_hits struct<Hit:array<struct<Hit_accession:string,Hit_def:string,Hit_hsps:struct<Hsp:array<{hsp}>>>>>"
    texts = spark.read.option("lineSep", "</Iteration>").text(path).withColumn("at", F.regexp_instr("value", F.lit(r"<Iteration[\s>]"))).where("at > 0")
    one = F.concat(F.substring("value", F.col("at"), F.length("value")), F.lit("</Iteration>"))
    rows = texts.select(F.from_xml(one, schema, {"rowTag": "Iteration"}).alias("x")).select("x.*")
    hits = rows.select(F.split("Iteration_query-def", " ")[0].alias("query"), F.explode("Iteration_hits.Hit").alias("h"))
    h = hits.select("query", F.col("h.Hit_accession").alias("hit"), F.explode("h.Hit_hsps.Hsp").alias("s"))
    s = lambda c: F.col("s")[c]
    return h.select("query", "hit", s("Hsp_align-len").alias("alen"), (100 * s("Hsp_identity") / s("Hsp_align-len")).alias("pid"), F.when(s("Hsp_hit-from") <= s("Hsp_hit-to"), "+").otherwise("-").alias("strand"), s("Hsp_query-from").alias("qf"), s("Hsp_query-to").alias("qt"), s("Hsp_hit-from").alias("hf"), s("Hsp_hit-to").alias("ht"))
