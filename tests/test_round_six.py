"""What the findings F20 to F34 of the third round were about, on small tables."""

import pytest

from hitloom.operators import assign, coverage, reads


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("sep", ["", " "])
def test_host_screen_makes_only_shared_kmers_distinct(spark, sep):
    table = spark.createDataFrame([("s", "a", sep.join("ACGTTGCA")), ("s", "a", sep.join("TTACGTTG")), ("s", "b", sep.join("GGGGGGGG")), ("s", "c", None)], "sample string, read_id string, seq string")
    removed = reads.remove_host_reads(table, spark.createDataFrame([(sep.join("CCACGTTGCC"),), (sep.join("CCACGTTGCC"),)], "seq string"), 5, 2, sep)[1]
    assert [tuple(r) for r in removed.collect()] == [("s", "a", 3)]
    below = plan_of(removed).split("Join Inner", 1)[1]
    assert below.count("Aggregate") == 1  # of the host's k-mers; the reads' aren't shuffled to be made distinct


def test_adapters_are_cut_once_in_batches(spark):
    rows = [("s", 1, "a", "ACGTACGTTTTTTTTTTTTT"), ("s", 2, "a", "ACGTACG"), ("s", 1, "b", "ACGAACGTACGTACGTTTTTTTTTTTTT"), ("s", 1, None, "ACGTACGT"), ("s", 1, "c", None), ("s", 1, "d", "acgtacgtéTTTTTTTTTTT")]
    table = spark.createDataFrame([(*r, r[3]) for r in rows], "sample string, mate int, read_id string, seq string, qual string")
    cut = reads.trim_adapter(table, "ACGTACGT", min_length=10, errors=1)
    plan = plan_of(cut)
    assert "Join" not in plan and plan.count("ArrowEvalPython") == 1
    assert {(r.read_id, r.seq, r.qual) for r in cut.collect()} == {("b", "T" * 12, "T" * 12), (None, "", ""), ("c", None, None), ("d", "é" + "T" * 11, "é" + "T" * 11)}


def test_mates_meet_without_arrays_of_hits(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(assign, "stage", lambda df: plans.append(plan_of(df)) or df)
    rows = [("s", "a", "+", 5, 60.0), ("s", "a", "-", 5, 52.0), ("s", "a", "-", 6, 61.0), ("s", "b", "+", 6, 9.0), ("s", "b", None, 5, 99.0), ("s", "c", "+", None, 9.0), ("s", "c", "-", 6, 8.0), ("s", "d", "+", 7, 50.0), ("s", "d", "-", 5, 51.0)]
    hits = spark.createDataFrame(rows, "sample string, query string, strand string, taxid int, bits double")
    path = lambda *t: [(x, "", "") for x in t]
    lineage = spark.createDataFrame([(1, path(1)), (5, path(1, 5)), (6, path(1, 6)), (7, path(1, 5, 7))], "taxid int, path array<struct<taxid: int, rank: string, name: string>>")
    got = {p: {r.query: r.lca_taxid for r in assign.paired_concordance(hits, lineage, p).collect()} for p in assign.PRESETS}
    assert got == {"pe_strict": {}, "pe_balanced": {"a": 5, "b": 5, "c": 6, "d": 5}, "pe_coord": {"a": 5, "b": 6, "c": 6, "d": 5}}
    assert len(plans) == 3 and all("lambda" not in p and p.count("RepartitionByExpression") == 1 for p in plans)


def test_strain_reads_are_counted_in_one_pass(spark):
    rows = [("s", 1, q, "T", a, a + 50, u) for q, a, u in [("a", 0, True), ("a", 500, True), ("b", 100, False), (None, 0, True), ("c", 900, True)]] + [("s", 2, None, "U", 0, 50, True)]
    hits = spark.createDataFrame(rows, "sample string, working_taxid int, query string, target string, tstart int, tend int, is_unique boolean")
    segment = [("s", t, 1000, 100, 0, 50, 50, 0.5) for t in (1, 2)]
    segments = spark.createDataFrame(segment, "sample string, working_taxid int, length int, breadth_bp int, masked_breadth_bp int, unique_breadth_bp int, multi_breadth_bp int, depth_entropy double")
    mask = spark.createDataFrame([("T", 0, 10), ("T", 520, 530)], "target string, start int, end int")
    refs = spark.createDataFrame([(1, "x", "T")], "taxid int, segment_name string, accession string")
    out = coverage.strain_coverage(hits, segments, mask, refs, spark.createDataFrame([(1, 1000)], "taxid int, expected_length int"))
    got = {r.working_taxid: (r.total_reads, r.unique_reads, r.multi_reads, r.masked_reads) for r in out.collect()}
    assert got == {1: (3, 2, 1, 1), 2: (0, 0, 0, 0)}
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
