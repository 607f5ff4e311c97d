"""Queries on readers and sinks: derived tables are written in a layout, read back, and compared with SQL on the tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.functions.stage import own_dir
from hitloom.operators import counts, reads
from hitloom.plans import q_cohort, q_cover
from hitloom.plans.derive import oracle, view
from hitloom.sources import readers, writers

QUERIES, SQL = {}, {}


def query(sql: str | None = None, views: str = "hits"):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = oracle(views, sql)
        return f

    return add


def folder(spark: SparkSession) -> str:
    return f"{own_dir(spark)}/files-{uuid.uuid4().hex}"


def put(values: DataFrame, **options: str | int) -> str:
    """Write the lines of `value` as text, with these options of the writer; the folder."""
    path = folder(values.sparkSession)
    values.select("value").write.options(**options).text(path)
    return path


def tabs(*columns):
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.concat_ws("\t", *(text(F.col(c) if isinstance(c, str) else c) for c in columns)).alias("value")


_HIT = "query, target, round(fident, 9) AS fident, alnlen, tstart, tend, round(evalue, 9) AS evalue, bits, qlen, tlen, taxid"


def _hit_columns(rows: DataFrame) -> DataFrame:
    return rows.select("query", "target", F.round("fident", 9).alias("fident"), "alnlen", "tstart", "tend", F.round("evalue", 9).alias("evalue"), "bits", "qlen", "tlen", "taxid")


def current_lines(h: DataFrame) -> DataFrame:
    one = F.lit(1)
    return h.select(tabs("query", "target", F.col("fident") * 100, "alnlen", one, "alnlen", "tstart", "tend", "evalue", "bits", "qlen", "tlen", "taxid", F.lit("Virus"), F.lit("a;b")))


def with_heading(spark: SparkSession, lines: DataFrame, heading: str) -> DataFrame:
    return spark.createDataFrame([(heading,), ("",)], "value string").unionByName(lines)


@query(f"SELECT {_HIT} FROM hits")
def source_hits(spark, d):
    path = put(with_heading(spark, current_lines(view(spark, d, "hits")), "query\ttarget\tfident"))
    return _hit_columns(readers.read_hits(spark, path))


@query(f"SELECT {_HIT} FROM hits")
def source_hits_legacy(spark, d):
    zero = F.lit(0)
    lines = view(spark, d, "hits").select(tabs("query", "target", "fident", "alnlen", zero, zero, zero, "alnlen", "tstart", "tend", F.format_string("%.6E", F.col("evalue").cast("double")), "bits", "qlen", "tlen", "taxid"))
    return _hit_columns(readers.read_hits(spark, put(lines)))


@query(f"SELECT {_HIT} FROM hits")
def source_blast_hits(spark, d):
    zero = F.lit(0)
    lines = view(spark, d, "hits").select(tabs("query", "target", F.col("fident") * 100, "alnlen", zero, zero, zero, "alnlen", "tstart", "tend", "evalue", "bits", F.lit("gi"), "target", "tlen", "qlen", F.concat(F.col("taxid").cast("string"), F.lit(";9")), F.lit("n"), F.lit("t"), zero, zero))
    return _hit_columns(readers.read_blast_hits(spark, put(with_heading(spark, lines, "# a comment"))))


@query("SELECT strand, count(*) AS n, count(DISTINCT query) AS queries, sum(alnlen)::BIGINT AS bases FROM hits GROUP BY strand")
def source_paired_hits(spark, d):
    h = view(spark, d, "hits")
    rows = readers.read_paired_hits(spark, put(current_lines(h.where("strand = '+'"))), put(current_lines(h.where("strand = '-'"))))
    return rows.groupBy("strand").agg(F.count("*").alias("n"), F.count_distinct("query").alias("queries"), F.sum("alnlen").alias("bases"))


@query(f"SELECT sample, {_HIT} FROM hits")
def source_hits_cache(spark, d):
    path = folder(spark)
    writers.write_hits_cache(view(spark, d, "hits"), path)
    rows = readers.read_hits_cached(spark, path + "-no-text", path)
    return rows.select("sample", *_hit_columns(rows).columns).withColumns({c: F.round(c, 9) for c in ("fident", "evalue")})


@query("SELECT target, lo AS lo, hi AS hi FROM mask", "mask")
def source_mask(spark, d):
    path = folder(spark)
    writers.write_bed(view(spark, d, "mask").select("target", "start", "end"), path)
    return readers.read_mask(spark, path).withColumnsRenamed({"start": "lo", "end": "hi"})


@query("SELECT taxid, parent_taxid, rank, CASE WHEN taxid % 10 = 7 THEN 'N/A' ELSE name END AS name FROM (SELECT taxid, parent_taxid, rank, min(name) OVER (PARTITION BY taxid) AS name, row_number() OVER (PARTITION BY taxid ORDER BY parent_taxid, rank) AS first_ FROM taxonomy) WHERE first_ = 1", "taxonomy")
def source_taxonomy(spark, d):
    t = view(spark, d, "taxonomy")
    row = lambda *c: F.concat(F.concat_ws("\t|\t", *(F.col(x).cast("string") if isinstance(x, str) else x for x in c)), F.lit("\t|")).alias("value")
    names = t.where("taxid % 10 != 7").select(row("taxid", "name", F.lit(""), F.lit("scientific name")))
    synonyms = t.select(row("taxid", F.concat(F.lit("A "), "name"), F.lit(""), F.lit("synonym")))
    return readers.read_taxonomy_dump(spark, put(t.select(row("taxid", "parent_taxid", "rank"))), put(names.unionByName(synonyms)))


@query("SELECT accession, taxid, length, title FROM refs", "refs")
def source_reference_tables(spark, d):
    path = folder(spark)
    view(spark, d, "refs").write.parquet(f"{path}/references")
    return readers.read_reference_tables(spark, path, ["references"])["references"].select("accession", "taxid", "length", "title")


_FA = "f AS (SELECT accession, concat('V', CAST(taxid AS STRING)) AS virus, segment_name AS segment, (length % 97 + 1)::INT AS length FROM refs WHERE taxid % 7 <> 0 OR segment_name = 'seg0')"


@query(f"WITH {_FA}, n AS (SELECT *, count(*) OVER (PARTITION BY virus) AS n, sum(length) OVER (PARTITION BY virus) AS genome_size FROM f) SELECT accession, virus, segment, length, genome_size::BIGINT AS genome_size FROM n WHERE n >= 2", "refs")
def source_fasta_segments(spark, d):
    r = view(spark, d, "refs").where("taxid % 7 != 0 OR segment_name = 'seg0'")
    lines = r.selectExpr("concat('>', accession, ' V', taxid, ' segment ', segment_name, ', complete\n', repeat('A', cast(length % 97 as int)), '\nC') AS value")
    return readers.segments_from_fasta(readers.fasta_lengths(spark, put(lines)))[0]


@query("SELECT concat(target, ' a->b >c') AS header, seq, length(seq) AS length FROM host_seqs", "host_seqs")
def source_fasta(spark, d):
    """Headers that hold `>`, sequences over several lines; lengths by another way than sequences."""
    lines = view(spark, d, "host_seqs").selectExpr("concat('>', target, ' a->b >c\n', substr(seq, 1, 70), '\n', substr(seq, 71, 70), '\r\n\n', substr(seq, 141)) AS value")
    path = put(lines)
    return readers.read_fasta(spark, path).join(readers.fasta_lengths(spark, path), "header").select("header", "seq", "length")


_LV = "lv AS (SELECT concat('s', CAST(taxid % 3 AS STRING)) AS sample, taxid AS line, rank, CAST((taxid * 7) % 6 AS INT) AS depth FROM taxonomy)"


@query(f"""WITH {_LV}, nr AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY line, depth, rank) AS k FROM lv),
go AS (SELECT sample, line, rank, k, least(depth, 0) AS depth FROM nr WHERE k = 1 UNION ALL SELECT n.sample, n.line, n.rank, n.k, least(n.depth, g.depth + 1) FROM nr n JOIN go g ON g.sample = n.sample AND n.k = g.k + 1)
SELECT sample, line, CASE rank WHEN 'superkingdom' THEN 'D' WHEN 'family' THEN 'F' WHEN 'genus' THEN 'G' WHEN 'species' THEN 'S' ELSE '-' END AS rank_code, depth FROM go""", "taxonomy")
def relevel_report(spark, d):
    rows = view(spark, d, "taxonomy").selectExpr("concat('s', taxid % 3) AS sample", "taxid AS line", "rank", "CAST((taxid * 7) % 6 AS INT) AS depth")
    return readers.relevel_report(rows).select("sample", "line", "rank_code", "depth")


@query(f"WITH {_LV} SELECT sample, line, depth, (SELECT max(p.line) FROM lv p WHERE p.sample = lv.sample AND p.line < lv.line AND p.depth < lv.depth) AS parent_taxid FROM lv", "taxonomy")
def report_parents(spark, d):
    rows = view(spark, d, "taxonomy").selectExpr("concat('s', taxid % 3) AS sample", "taxid AS line", "taxid", "CAST((taxid * 7) % 6 AS INT) AS depth")
    return readers.with_parents(rows).select("sample", "line", "depth", "parent_taxid")


@query(f"WITH {q_cohort._FQ} SELECT read_id, seq, translate(seq, 'ACGT', '5?IF') AS qual FROM fq")
def source_fastq(spark, d):
    lines = q_cohort.fastq(spark, d).select(F.concat(F.lit("@"), "read_id", F.lit(" lane\n"), "seq", F.lit("\n+\n"), "qual").alias("value"))
    return readers.read_fastq(spark, put(lines)).select("read_id", "seq", "qual")


@query(f"WITH {q_cohort._FQ} SELECT concat('>', read_id) AS header, seq FROM fq")
def fastq_to_fasta(spark, d):
    fasta = readers.read_fasta(spark, put(reads.fastq_to_fasta(q_cohort.fastq(spark, d))))
    return fasta.select(F.concat(F.lit(">"), "header").alias("header"), "seq")


_TOOL = "SELECT concat('tool', CAST(k AS STRING)) AS kind, taxid::BIGINT AS taxid, sum(reads)::BIGINT AS reads FROM counts, (SELECT unnest(range(4)) AS k) WHERE (taxid + k) % 3 <> 0 GROUP BY ALL"


@query(_TOOL, "counts")
def source_tool_counts(spark, d):
    c, n = view(spark, d, "counts"), F.lit(0)
    layouts = {
        "bracken": ("name", "taxid", F.lit("S"), n, n, "reads", F.lit(0.5)), "ganon": (F.lit("species"), "taxid", F.lit("l"), F.lit("n"), n, n, n, "reads", n),
        "metabuli": (n, "reads", n, F.lit("species"), "taxid", "name"), "kreport": (n, "reads", n, F.lit("S"), "taxid", "name"),
    }
    out = None
    for k, (tool, columns) in enumerate(layouts.items()):
        lines = c.where((F.col("taxid") + k) % 3 != 0).withColumn("name", F.lit("x")).select(tabs(*columns))
        rows = readers.read_tool_counts(spark, put(with_heading(spark, lines, "a\tb\tG\tgenus\t1\t2\t3\t4\t5")), tool).select(F.lit(f"tool{k}").alias("kind"), "taxid", "reads")
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("kind", "taxid").agg(F.sum("reads").alias("reads"))


DOCUMENT = 50_000  # lines of a BLAST XML document, its first and last among them


def _documents(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Each partition's lines as documents of their own, all but the last of `size` lines: files of as many records hold one document each."""
    line = lambda text: pa.RecordBatch.from_arrays([pa.array([text])], ["value"])
    first, last = line("<BlastOutput><BlastOutput_iterations>"), line("</BlastOutput_iterations></BlastOutput>")
    room = size - 2
    yield first
    for batch in batches:
        while batch.num_rows > room:
            yield from (batch.slice(0, room), last, first)
            batch, room = batch.slice(room), size - 2
        yield batch
        room -= batch.num_rows
    yield last


_SHEET = "sheet AS (SELECT concat('p', CAST(s_suppkey % 40 AS STRING), CASE WHEN s_suppkey % 29 = 0 THEN ' x' ELSE '' END) AS sample, concat('f', CAST(s_suppkey AS STRING), CASE WHEN s_suppkey % 11 = 0 THEN '.txt' ELSE '.fastq.gz' END) AS fastq_1, CASE WHEN s_suppkey % 2 = 0 THEN concat('g', CAST(s_suppkey AS STRING), '.fq.gz') END AS fastq_2 FROM supplier)"


def sheet(spark, d) -> str:
    s = spark.read.parquet(f"{d}/supplier.parquet")
    path = folder(spark)
    s.selectExpr(
        "concat('p', s_suppkey % 40, CASE WHEN s_suppkey % 29 = 0 THEN ' x' ELSE '' END) AS sample", "concat('f', s_suppkey, CASE WHEN s_suppkey % 11 = 0 THEN '.txt' ELSE '.fastq.gz' END) AS fastq_1",
        "CASE WHEN s_suppkey % 2 = 0 THEN concat('g', s_suppkey, '.fq.gz') END AS fastq_2",
    ).write.option("header", True).csv(path)
    return path


@query(f"WITH {_SHEET} SELECT sample, bool_and(fastq_2 IS NULL) AS single_end, (count(fastq_1) + count(fastq_2))::BIGINT AS files FROM sheet GROUP BY sample")
def source_samplesheet(spark, d):
    return readers.read_samplesheet(spark, sheet(spark, d))[0].select("sample", "single_end", F.size(F.flatten("fastq")).cast("long").alias("files"))


@query(f"WITH {_SHEET} SELECT sample, 'a blank in the name' AS problem FROM sheet WHERE contains(sample, ' ') UNION ALL SELECT sample, 'bad fastq_1' FROM sheet WHERE NOT ends_with(fastq_1, '.gz') UNION ALL SELECT sample, 'single and paired runs' FROM sheet GROUP BY sample HAVING count(fastq_2) BETWEEN 1 AND count(*) - 1")
def samplesheet_violations(spark, d):
    return readers.read_samplesheet(spark, sheet(spark, d))[1]


@query("SELECT query, hit, alen, round(100.0 * floor(alen * pid / 100) / alen, 9) AS pid, strand, qf, qt, CASE WHEN strand = '+' THEN hf ELSE ht END AS hf, CASE WHEN strand = '+' THEN ht ELSE hf END AS ht FROM hsps", "hsps")
def source_blast_xml(spark, d):
    h = view(spark, d, "hsps")
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), c.cast("string"), F.lit(f"</{name}>"))
    plus = F.col("strand") == "+"
    hsp = F.concat(
        tag("Hsp_query-from", F.col("qf")), tag("Hsp_query-to", F.col("qt")), tag("Hsp_hit-from", F.when(plus, F.col("hf")).otherwise(F.col("ht"))), tag("Hsp_hit-to", F.when(plus, F.col("ht")).otherwise(F.col("hf"))),
        tag("Hsp_identity", F.floor(F.col("alen") * F.col("pid") / 100)), tag("Hsp_align-len", F.col("alen")),
    )
    line = F.concat(F.lit("<Iteration>"), tag("Iteration_query-def", F.concat("query", F.lit(" a virus"))), F.lit("<Iteration_hits><Hit>"), tag("Hit_accession", F.col("hit")), F.lit("<Hit_def>x</Hit_def><Hit_hsps><Hsp>"), hsp, F.lit("</Hsp></Hit_hsps></Hit></Iteration_hits></Iteration>"))
    files = h.select(line.alias("value")).mapInArrow(partial(_documents, size=DOCUMENT), "value string")
    # tags are most of a document; a compressed one is read in one split, so it is short
    path = put(files, compression="gzip", maxRecordsPerFile=DOCUMENT)
    return readers.read_blast_xml(spark, path).withColumn("pid", F.round("pid", 9))


_WIDE = ", ".join(f"sum(CASE WHEN sample = 'c{i}' THEN reads ELSE 0 END)::DOUBLE AS c{i}" for i in range(24))


@query("WITH" + q_cover.LINEAGE + f", w AS (SELECT taxid, {_WIDE} FROM counts GROUP BY taxid), u AS (UNPIVOT w ON COLUMNS('^c[0-9]+$') INTO NAME sample VALUE value) SELECT sample, a::BIGINT AS taxid, ar AS rank, an AS name, value, d::INT AS depth FROM u JOIN anc USING (taxid)", "counts taxonomy")
def source_lineage_report(spark, d):
    samples = [f"c{i}" for i in range(24)]
    wide = q_cohort.cohort.pivot_samples(view(spark, d, "counts"), "taxid", samples, "reads")
    line = lambda c: F.array_join(F.transform("path", c), "|")
    rows = wide.join(q_cover.lin(spark, d), "taxid").select(line(lambda p: F.concat(p["rank"], F.lit("_"), p["name"])).alias("names"), line(lambda p: p["taxid"].cast("string")).alias("ids"), *samples)
    path = folder(spark)
    rows.write.option("header", True).option("sep", "\t").csv(path)
    return readers.read_lineage_report(spark, path, samples)


_DIRECT = q_cover._ASSIGN + f",{q_cover.CLADES}"


def clades(spark, d) -> tuple[DataFrame, DataFrame]:
    lineage = q_cover.lin(spark, d)
    return counts.clade_counts(q_cover.assigned_best(spark, d), lineage), lineage


@query(_DIRECT + " SELECT taxid::BIGINT AS taxid, reads AS clade, direct, coalesce(depth, 0)::INT AS depth, CASE WHEN depth > 0 THEN parent_taxid END::BIGINT AS parent_taxid, name FROM direct", "hits taxonomy")
def report_round_trip(spark, d):
    """The hierarchical report of each sample, written in order and read back: parents follow from the indentation."""
    path = folder(spark)
    writers.write_lines(writers.report_lines(*clades(spark, d)), path, "line")
    return readers.read_kreport(spark, path).select("taxid", "clade", "direct", "depth", "parent_taxid", "name")


@query(q_cover._ASSIGN + " SELECT concat_ws(chr(9), 'C', query, CAST(lca_taxid AS STRING), '100', array_to_string(ids, '|')) AS value FROM asg JOIN lin ON lin.taxid = lca_taxid", "hits taxonomy")
def sink_read_lines(spark, d):
    rows = q_cover.assigned_best(spark, d).withColumn("qlen", F.lit(100))
    path = folder(spark)
    writers.write_lines(writers.read_lines(rows, q_cover.lin(spark, d)), path)
    return spark.read.text(path).select("value")


@query(q_cover._ASSIGN + " SELECT sample, query, lca_taxid, read_count, concat(CAST(lca_taxid AS STRING), ',7') AS all_taxids FROM asg", "hits taxonomy")
def sink_assignments(spark, d):
    path = folder(spark)
    writers.write_table(q_cover.assigned_best(spark, d).select("sample", "query", "lca_taxid", "read_count", F.array("lca_taxid", F.lit(7)).alias("all_taxids")), path, ",", by_sample=True)
    return spark.read.schema("query string, lca_taxid int, read_count int, all_taxids string, sample string").option("header", True).csv(path)


@query("SELECT sample, taxid, reads FROM counts WHERE reads > 0", "counts")
def sink_matrix(spark, d):
    """All samples and taxa as a matrix with samples as rows, read back as a long table without zeros."""
    path = folder(spark)
    writers.write_matrix(view(spark, d, "counts").withColumnRenamed("reads", "value"), path, [])
    return readers.read_matrix(spark, path).select("sample", F.col("taxid").cast("int").alias("taxid"), F.col("value").cast("long").alias("reads")).where("reads > 0")


@query("SELECT sample FROM (SELECT DISTINCT sample FROM counts) WHERE sample NOT IN (SELECT sample FROM hits)", "hits counts")
def sink_empty_samples(spark, d):
    path, samples = folder(spark), view(spark, d, "hits").select("sample").union(view(spark, d, "counts").select("sample"))
    writers.write_empty_samples(counts.partition_nonempty_samples(q_cover.assigned_best(spark, d), samples), path)
    return spark.read.text(path).withColumnRenamed("value", "sample")


@query(_DIRECT + " SELECT sample, taxid, row_number() OVER (PARTITION BY sample ORDER BY depth ASC NULLS LAST, reads DESC, taxid)::INT AS line FROM clades", "hits taxonomy")
def clade_table_order(spark, d):
    return writers.in_order(clades(spark, d)[0], "clades").select("sample", "taxid", "line")


@query(f"SELECT sample, working_taxid, row_number() OVER (PARTITION BY sample ORDER BY read_count DESC, working_taxid)::INT AS line FROM ({q_cover.SQL['abundance_tpm']})")
def abundance_order(spark, d):
    return writers.in_order(q_cover.abundance_of(spark, d), "abundance").select("sample", "working_taxid", "line")


@query(f"SELECT sample, taxon, row_number() OVER (PARTITION BY sample ORDER BY total_reads DESC, taxon)::INT AS line FROM ({q_cover.SQL['coverage_summary']})")
def summary_order(spark, d):
    return writers.in_order(q_cover.coverage_summary(spark, d), "summary").select("sample", "taxon", "line")


@query("SELECT target, sample, count(*) AS n FROM hits GROUP BY ALL")
def source_results(spark, d):
    """Result tables of many samples, found by pattern; the files of a sample carry its name."""
    path = folder(spark)
    h = view(spark, d, "hits").groupBy("sample", "target").agg(F.count("*").alias("n"))
    writers.write_table(h.withColumn("own", F.col("sample")), path, ",", by_sample=True)
    rows = readers.read_results(spark, f"{path}/*/*.csv")
    return rows.groupBy("target", F.col("own").alias("sample")).agg(F.sum("n").alias("n"))


