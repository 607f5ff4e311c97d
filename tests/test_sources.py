import gzip

from hitloom.operators import counts, taxonomy
from hitloom.sources import readers, writers

HIT = ["r1/1", "T1", "95.0", "80", "1", "80", "10", "90", "1e-9", "120.5", "100", "2000", "3001", "Virus A", "x;y"]


def put(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_hit_layouts(spark, tmp_path):
    current = "\t".join(["query", "target"] + ["c"] * 13) + "\n" + "\t".join(HIT) + "\n" + "\t".join(["r2", "T1", "80", *HIT[3:]]) + "\n"
    put(tmp_path, "s1_R1.tsv", current)
    put(tmp_path, "s2_R1.tsv", "r9\tT2\t0.9\t70\t3\t0\t1\t70\t5\t75\t1.0E-5\t99.5\t100\t2000\t3002\n")
    put(tmp_path, "s3_R1.tsv", "")
    put(tmp_path, "s4_R1.tsv", "\t".join(["query", "target"] + ["c"] * 13) + "\n")
    rows = {(r.sample, r.query): r for r in readers.read_hits(spark, str(tmp_path) + "/*_R1.tsv").collect()}
    assert set(rows) == {("s1", "r1/1"), ("s1", "r2"), ("s2", "r9")}
    assert rows["s1", "r1/1"].fident == 0.95 and rows["s1", "r1/1"].taxid == 3001 and rows["s1", "r1/1"].taxname == "Virus A"
    assert rows["s2", "r9"].evalue == 1e-5 and rows["s2", "r9"].bits == 99.5 and rows["s2", "r9"].tstart == 5 and rows["s2", "r9"].tlen == 2000
    both = readers.read_paired_hits(spark, str(tmp_path / "s1_R1.tsv"), str(tmp_path / "s2_R1.tsv"))
    assert {r.strand for r in both.collect()} == {"+", "-"}
    writers.write_hits_cache(both, str(tmp_path / "cache"))
    assert spark.read.parquet(str(tmp_path / "cache")).count() == 3


def test_blast_layout(spark, tmp_path):
    path = put(tmp_path, "a.tsv", "# comment\nq\tt\t97.5\t80\t1\t0\t1\t80\t10\t90\t1e-9\t120\tgi\tacc\t2000\t100\t11;12\tname\ttitle\t80\t80\n")
    r = readers.read_blast_hits(spark, path).first()
    assert (r.fident, r.taxid, r.tlen, r.qlen, r.tend) == (0.975, 11, 2000, 100, 90)


def test_mask_taxonomy_sheet(spark, tmp_path):
    assert readers.read_mask(spark, put(tmp_path, "m.bed", "T1\t5\t10\tx\nT1\tbad\t3\nT2\t0\t4\n")).count() == 2
    nodes = put(tmp_path, "nodes.dmp", "1\t|\t1\t|\tno rank\t|\n2\t|\t1\t|\tgenus\t|\n3\t|\t2\t|\tspecies\t|\n")
    names = put(tmp_path, "names.dmp", "1\t|\troot\t|\t\t|\tscientific name\t|\n2\t|\tG\t|\t\t|\tscientific name\t|\n2\t|\tGee\t|\t\t|\tsynonym\t|\n")
    tax = readers.read_taxonomy_dump(spark, nodes, names)
    assert {(r.taxid, r.parent_taxid, r.name) for r in tax.collect()} == {(1, 1, "root"), (2, 1, "G"), (3, 2, "N/A")}
    sheet = put(tmp_path, "sheet.csv", "sample,fastq_1,fastq_2\na,a1.fastq.gz,a2.fq.gz\na,b1.fq.gz,b2.fq.gz\nb,b.fastq.gz,\nb b,x.txt,\nc,c.fq.gz,\nc,c1.fq.gz,c2.fq.gz\n")
    samples, bad = readers.read_samplesheet(spark, sheet)
    got = {r["sample"]: r for r in samples.collect()}
    assert not got["a"].single_end and len(got["a"].fastq) == 2 and got["b"].single_end
    assert {(r["sample"], r.problem) for r in bad.collect()} == {("b b", "a blank in the name"), ("b b", "bad fastq_1"), ("c", "single and paired runs")}


def test_sequences(spark, tmp_path):
    fasta = readers.read_fasta(spark, put(tmp_path, "r.fasta", ">NC_1 Flu A segment 1, x\nACGT\nAC\n>NC_2 Flu A segment 2\nGG\n>NC_3 Lone segment 1\nA\n"))
    segments, histogram = readers.segments_from_fasta(fasta)
    assert {(r.accession, r.length, r.genome_size) for r in segments.collect()} == {("NC_1", 6, 8), ("NC_2", 2, 8)}
    assert [(r.n, r.viruses) for r in histogram.collect()] == [(2, 1)]
    record = "@r1 x\nACGT\n+\n@III\n@r2\nGG\n+\nII\n"
    plain = readers.read_fastq(spark, put(tmp_path, "s1_R1.fastq", record))
    with gzip.open(tmp_path / "s2_R1.fastq.gz", "wt") as f:
        f.write(record)
    zipped = readers.read_fastq(spark, str(tmp_path / "s2_R1.fastq.gz"))
    for rows, name in ((plain, "s1"), (zipped, "s2")):
        assert {(r["sample"], r.read_id, r.seq, r.qual) for r in rows.collect()} == {(name, "r1", "ACGT", "@III"), (name, "r2", "GG", "II")}


def test_reports(spark, tmp_path):
    text = "100.00\t10\t0\t-\t1\troot\n90.00\t9\t1\tD\t10239\t  Viruses\n50.00\t5\t5\tG\t5\t    Gee\n30.00\t3\t3\tG\t6\t    Hee\n"
    rows = readers.read_kreport(spark, put(tmp_path, "s1.kreport", text)).collect()
    assert {(r.taxid, r.parent_taxid, r.depth) for r in rows} == {(1, None, 0), (10239, 1, 1), (5, 10239, 2), (6, 10239, 2)}
    loose = spark.createDataFrame([("s", 1, "superkingdom", 0), ("s", 2, "genus", 4), ("s", 3, "species", 5)], "sample string, line int, rank string, depth int")
    assert [(r.rank_code, r.depth) for r in readers.relevel_report(loose).orderBy("line").collect()] == [("D", 0), ("G", 1), ("S", 2)]
    wide = put(tmp_path, "w.tsv", "names\tids\ta\tb\nsuperkingdom_Viruses|genus_Gee\t10239|5\t3\t4\n")
    assert readers.read_lineage_report(spark, wide, ["a", "b"]).where("taxid = 5 and sample = 'b' and value = 4 and rank = 'genus' and name = 'Gee' and depth = 1").count() == 1
    br = put(tmp_path, "s9.bracken", "name\ttaxonomy_id\ttaxonomy_lvl\tk\ta\tnew_est_reads\tf\nX\t7\tS\t1\t2\t12\t.5\nY\t8\tG\t1\t2\t9\t.5\n")
    assert [(r.taxid, r.reads) for r in readers.read_tool_counts(spark, br, "bracken").collect()] == [(7, 12)]
    put(tmp_path, "x_read_classification.csv", "query,lca_taxid\nr,5\n")
    assert readers.read_results(spark, str(tmp_path) + "/*_classification.csv").first()["sample"] == "x"


def test_blast_xml(spark, tmp_path):
    xml = """<BlastOutput><BlastOutput_iterations><Iteration><Iteration_query-def>V1 some virus</Iteration_query-def><Iteration_hits>
<Hit><Hit_accession>chr1</Hit_accession><Hit_def>d</Hit_def><Hit_hsps><Hsp><Hsp_query-from>5</Hsp_query-from><Hsp_query-to>204</Hsp_query-to><Hsp_hit-from>900</Hsp_hit-from><Hsp_hit-to>701</Hsp_hit-to><Hsp_identity>190</Hsp_identity><Hsp_align-len>200</Hsp_align-len></Hsp></Hit_hsps></Hit>
</Iteration_hits></Iteration></BlastOutput_iterations></BlastOutput>"""
    r = readers.read_blast_xml(spark, put(tmp_path, "b.xml", xml)).first()
    assert (r.query, r.hit, r.alen, r.pid, r.strand, r.qf, r.ht) == ("V1", "chr1", 200, 95.0, "-", 5, 701)


def test_sinks(spark, tmp_path):
    tax = spark.createDataFrame([(1, 1, "no rank", "root"), (10239, 1, "superkingdom", "Viruses"), (5, 10239, "genus", "Gee"), (6, 10239, "genus", "Hee")], "taxid int, parent_taxid int, rank string, name string")
    lineage = taxonomy.lineages(tax)
    assigned = spark.createDataFrame([("s", "r1", 5, 1, 100), ("s", "r2", 6, 1, 100), ("s", "r3", 6, 1, 90), ("s", "r4", 0, 1, 80)], "sample string, query string, lca_taxid int, read_count int, qlen int")
    lines = {r.value for r in writers.read_lines(assigned, lineage).collect()}
    assert "C\tr1\t5\t100\t1|10239|5" in lines and "U\tr4\t0\t80\t0" in lines
    report = [r.value for r in writers.report_lines(counts.clade_counts(assigned, lineage), lineage).orderBy("line").collect()]
    assert report == ["100.00\t3\t0\tD\t10239\tViruses", " 66.67\t2\t2\tG\t6\t  Hee", " 33.33\t1\t1\tG\t5\t  Gee"]
    writers.write_lines(writers.report_lines(counts.clade_counts(assigned, lineage), lineage), str(tmp_path / "rep"), "line")
    assert spark.read.text(str(tmp_path / "rep")).count() == 3
    otu = counts.otu_table(assigned.where("lca_taxid > 0"))
    writers.write_matrix(otu, str(tmp_path / "wide"), ["s"])
    assert spark.read.option("header", True).csv(str(tmp_path / "wide")).columns == ["sample", "5", "6"]
    writers.write_table(assigned.limit(0), str(tmp_path / "none"))
    writers.write_bed(spark.createDataFrame([("a", 1, 2)], "acc string, start int, end int"), str(tmp_path / "bed"))
    assert readers.read_mask(spark, str(tmp_path / "bed")).count() == 1
    writers.write_empty_samples(counts.partition_nonempty_samples(assigned, spark.createDataFrame([("s",), ("t",)], "sample string")), str(tmp_path / "empty"))
    assert [r.value for r in spark.read.text(str(tmp_path / "empty")).collect()] == ["t"]


def test_matrix_of_many_taxa(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "MATRIX_COLUMNS", 3, raising=False)
    n = 7
    otu = spark.createDataFrame([(s, t, t + k) for k, s in enumerate("ab") for t in range(n) if t != k], "sample string, taxid int, value int")
    writers.write_matrix(otu, str(tmp_path / "wide"), ["a", "b"])
    got = {}
    for part in sorted((tmp_path / "wide").glob("columns_*")):
        for r in spark.read.option("header", True).csv(str(part)).collect():
            got |= {(r["sample"], t): int(v) for t, v in r.asDict().items() if t != "sample"}
    assert got == {(s, str(t)): 0 if t == k else t + k for k, s in enumerate("ab") for t in range(n)}
