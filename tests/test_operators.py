import random

import pytest
from pyspark.sql import functions as F

from hitloom.functions import tails, text
from hitloom.operators import assign, cohort, counts, em, hits, intervals, reads, taxonomy
from hitloom.plans import pipelines

HIT = "sample string, query string, target string, strand string, tstart int, tend int, tlen int"


def hit(spark, rows, length=1000):
    return spark.createDataFrame([("s", f"r{i}", t, "+", a, b, length) for i, (t, a, b) in enumerate(rows)], HIT)


@pytest.mark.parametrize("spans,want", [([(0, 1000)], 1.0), ([(0, 600), (400, 800)], 0.8), ([(0, 2000)], 1.0), ([(5, 5)], 0.0)])
def test_merged_coverage(spark, spans, want):
    got = intervals.merged_coverage_ratio(hit(spark, [("T", a, b) for a, b in spans])).first().coverage_ratio
    assert got == pytest.approx(want)


def test_intervals_against_bases(spark):
    rng = random.Random(0)
    rows, length = [], 400
    for t in range(40):
        for _ in range(rng.randrange(1, 30)):
            a = rng.randrange(-5, 420)
            rows.append((f"T{t}", a, a + rng.randrange(0, 90)))
    h = hit(spark, rows, length)
    depth = {}
    for t, a, b in rows:
        for p in range(max(a, 0), min(b, length)):
            depth[t, p] = depth.get((t, p), 0) + 1
    for r in intervals.breadth_depth(h).collect():
        own = [v for (t, _), v in depth.items() if t == r.target]
        assert r.breadth_bp == len(own) and r.avg_depth == pytest.approx(sum(own) / len(own))
    got = {}
    for r in intervals.depth_segments(intervals.clamp(h)).collect():
        for p in range(r.start, r.end):
            got[r.target, p] = r.depth
    assert got == depth


def test_masked_hits(spark):
    mask = spark.createDataFrame([("T", 400, 600), ("A", 100, 300)], "target string, start int, end int")
    rows = [("T", 300, 500), ("T", 298, 500), ("T", 0, 200), ("T", 450, 550), ("A", 120, 280), ("A", 0, 80), ("A", 50, 250), ("A", 290, 400)]
    got = {(r.target, r.tstart, r.tend): r.is_masked for r in hits.label_masked_hits(hit(spark, rows), mask).collect()}
    assert [got[r] for r in rows] == [True, False, False, True, True, False, True, False]
    assert not hits.label_masked_hits(hit(spark, rows), mask.limit(0)).where("is_masked").count()


def test_names(spark):
    rows = spark.createDataFrame([("read1/1",), ("@M00967:1:1101:1000:1000 1:N:0:1",), (None,)], "h string")
    assert [r[0] for r in rows.select(text.normalize_read_id(F.col("h"))).collect()] == ["read1", "M00967:1:1101:1000:1000", None]
    names = spark.createDataFrame([("/a/b/sample1_R1.fastq.gz",)], "f string")
    assert names.select(text.sample_name(F.col("f"))).first()[0] == "sample1"
    hosts = spark.createDataFrame([("Homo sapiens",), ("Escherichia coli",), (" ",), ("soil bacterium",), (None,)], "h string")
    assert [r[0] for r in hosts.select(text.host_genus(F.col("h"), "(metagenome)")).collect()] == [None, "Escherichia", None, "(metagenome)", None]
    kinds = spark.createDataFrame([("ssRNA-RT",), ("dsDNA; ssDNA",), ("ssDNA(+)",), ("Viroid",), (None,)], "g string")
    assert [r[0] for r in kinds.select(text.genome_type(F.col("g"))).collect()] == ["RT", "Other", "ssDNA", "Other", "Other"]
    ranks = spark.createDataFrame([("genus", "Species"), ("clade", "species"), ("strain", "strain")], "a string, b string")
    assert [r[0] for r in ranks.select(text.compare_ranks(F.col("a"), F.col("b"))).collect()] == [-1, 1, 0]


def test_tails(spark):
    rows = spark.createDataFrame([(1.959963985, 3.841458821, 2.228138852)], "z double, x double, t double")
    r = rows.select(tails.normal_two_sided("z"), tails.chi2_upper("x", F.lit(1.0)), tails.t_two_sided("t", F.lit(10.0))).first()
    assert list(r) == pytest.approx([0.05, 0.05, 0.05], abs=1e-7)


TAX = [(1, 1, "no rank", "root"), (10239, 1, "superkingdom", "Viruses"), (20, 10239, "family", "F"), (30, 20, "genus", "G"), (31, 20, "genus", "H"), (40, 30, "species", "a"), (41, 30, "species", "b"), (42, 31, "species", "c")]


@pytest.fixture(scope="module")
def lineage(spark):
    return taxonomy.lineages(spark.createDataFrame(TAX, "taxid int, parent_taxid int, rank string, name string")).persist()


def test_lca(spark, lineage):
    sets = spark.createDataFrame([(1, 40), (1, 41), (2, 40), (2, 42), (3, 40), (4, -5), (5, 999), (6, 40), (6, 999)], "k int, taxid int")
    got = {r.k: (r.lca_taxid, r.n_taxids) for r in taxonomy.lca_of_sets(sets, lineage, ("k",)).collect()}
    assert got == {1: (30, 2), 2: (20, 2), 3: (40, 1), 6: (40, 1)}


def test_clades_and_rollups(spark, lineage):
    rows = spark.createDataFrame([("s", "q1", 40, 1, 1), ("s", "q2", 30, 1, 2), ("s", "q3", -7, 1, 1), ("s", "q4", 42, 1, 1)], "sample string, query string, lca_taxid int, read_count int, n_unique_taxids int")
    clades = counts.direct_counts(counts.clade_counts(rows, lineage))
    got = {r.taxid: (r.reads, r.direct, r.depth) for r in clades.collect()}
    assert got == {10239: (3, 0, 0), 20: (3, 0, 1), 30: (2, 1, 2), 31: (1, 0, 2), 40: (1, 1, 3), 42: (1, 1, 3)}
    assert sum(d for _, d, _ in got.values()) == 3
    up = counts.taxon_rollups(rows, lineage)
    assert {(r["rank"], r.key): r.reads for r in up.collect()} == {("species", "a"): 1, ("species", "c"): 1, ("species", "_unmapped"): 2, ("genus", "G"): 2, ("genus", "H"): 1, ("genus", "_unmapped"): 1}
    assert counts.fp_postfilter(rows, 0.2, 0.9, 1).count() == 3


def test_em_prefers_supported_taxa(spark):
    rows = [("s", f"u{i}", 1, 10.0) for i in range(8)] + [("s", "v", 2, 10.0)] + [("s", f"m{i}", k, 10.0) for i in range(6) for k in (1, 2)]
    cands = spark.createDataFrame(rows, "sample string, query string, species int, score double")
    lengths = spark.createDataFrame([(1, 2000), (2, 2000)], "species int, length int")
    share = em.em_abundance(cands, lengths)
    a = {r.species: r.a for r in share.collect()}
    assert sum(a.values()) == pytest.approx(1) and a[1] > 0.85
    assert {r.species for r in em.em_assign(cands, share).where("query like 'm%'").collect()} == {1}
    assert em.em_abundance(cands.limit(0), lengths).count() == 0


def test_cohort(spark):
    rows = spark.createDataFrame([("a", 1, 4), ("a", 2, 6), ("b", 1, 4), ("b", 2, 6), ("c", 3, 5)], "sample string, taxid int, reads int")
    d = {(r.a, r.b): r.distance for r in cohort.bray_curtis(rows).collect()}
    assert d == {("a", "b"): 0.0, ("a", "c"): 1.0, ("b", "c"): 1.0}
    p = cohort.pcoa(cohort.bray_curtis(rows)).orderBy("sample").collect()
    assert p[0].axis1 == pytest.approx(p[1].axis1, abs=1e-7) and p[0].explained1 == pytest.approx(1)
    assert cohort.alpha_diversity(rows).where("sample = 'c'").first().pielou == 0
    q = spark.createDataFrame([(0.01,), (0.02,), (0.03,), (0.5,)], "p_value double")
    assert [round(r.q_value, 6) for r in cohort.bh_fdr(q).orderBy("p_value").collect()] == [0.04, 0.04, 0.04, 0.5]


def test_modes(spark, lineage):
    rows = []
    for i in range(60):
        rows.append(("s", f"r{i}", "N1", "+", 0.95, 90, (i * 30) % 1800, (i * 30) % 1800 + 90, 1e-9, 150.0, 100, 2000, 40))
        if i % 3 == 0:
            rows.append(("s", f"r{i}", "N2", "-", 0.9, 80, 10, 90, 1e-9, 120.0, 100, 2000, 41))
    schema = "sample string, query string, target string, strand string, fident double, alnlen int, tstart int, tend int, evalue double, bits double, qlen int, tlen int, taxid int"
    h = spark.createDataFrame(rows, schema)
    mask = spark.createDataFrame([("N1", 0, 50)], "target string, start int, end int")
    refs = spark.createDataFrame([("N1", 40, 2000, "1", "x", 2000), ("N2", 41, 2000, "1", "y", 2000)], "accession string, taxid int, length int, segment_name string, title string, expected_genome_length int")
    for mode in ("coverage", "lca", "lca_conditional", "em"):
        out = pipelines.classify(mode, h, mask, refs, lineage)
        calls = {r.lca_taxid for r in out["assigned"].collect()}
        assert 40 in calls, mode
        if "abundance" in out and "tpm" in out["abundance"].columns:
            assert out["abundance"].agg(F.sum("tpm")).first()[0] == pytest.approx(1e6)
    merged = pipelines.merge_otu(out["assigned"], lineage, h.select("sample"), min_count=1)
    assert set(merged) == {"empty", "raw", "genus", "species"} and merged["empty"].count() == 0
    assert assign.paired_concordance(h.limit(0), lineage, "pe_coord").count() == 0


def test_read_jobs(spark):
    rows = [("s", 1, "a", "ACGT" * 3 + "G" * 12, "I" * 24), ("s", 2, "a", "ACGTTTTTTTTTTTTT", "5" * 16), ("s", 1, "b", "TTACGGATCA", "I" * 10)]
    r = spark.createDataFrame(rows, "sample string, mate int, read_id string, seq string, qual string")
    cut = {(x.read_id, x.mate): (x.seq, x.qual) for x in reads.trim_tails(r, 10, 3).collect()}
    assert cut["a", 1] == ("ACGT" * 3, "I" * 12) and cut["a", 2] == ("ACG", "555")
    assert {x.read_id for x in reads.trim_adapter(r, "ACGT", min_length=11).collect()} == {"a"}
    kept, gone = reads.remove_host_reads(r, spark.createDataFrame([("TTACGGATC",)], "seq string"), 5, 2)
    assert {x.read_id for x in kept.collect()} == {"a"} and gone.first().host_kmers == 5
    seeds = reads.kmer_seed_search(r, spark.createDataFrame([("T", "GGTTACGGATCA")], "target string, seq string"), 5, 3)
    assert (seeds.first().diagonal, seeds.first().seeds) == (2, 6)
    q = reads.fastq_quality_profile(r).where("mate = 2 and pos = 0").first()
    assert q.bases == 1 and q.mean_q == 20 and q.share_a == 1
