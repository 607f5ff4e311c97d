"""Steps of whole runs, compositions, order of results, deep taxonomies, mask bins and FASTQ splits on small cases."""

import random

import pytest
from pyspark.sql import functions as F

from hitloom.operators import assign, composition, coverage, hits, intervals, mask, ml, taxonomy
from hitloom.plans import pipelines
from hitloom.sources import readers, writers

HIT = "sample string, query string, target string, tstart int, tend int, tlen int, taxid int, bits double, fident double"


def test_method_b_takes_the_best_hit_of_all_hits(spark):
    """r1's best hit lies on a reference that its best hits cover too little: the read is lost, not moved to another."""
    rows = [("s", "r1", "narrow", 0, 5, 1000, 1, 99.0, 1.0), ("s", "r1", "wide", 0, 100, 1000, 2, 50.0, 0.9)]
    rows += [("s", f"r{i}", "wide", 100 * i, 100 * i + 100, 1000, 2, 50.0, 0.9) for i in (2, 3, 4)]
    rows += [("s", f"q{i}", "masked", 0, 100, 1000, 3, 50.0, 0.9) for i in range(5)]
    m = spark.createDataFrame([("masked", 0, 200)], "target string, start int, end int")
    got = pipelines.method_b(spark.createDataFrame(rows, HIT), m).collect()
    assert [(r.taxid, r.read_count) for r in got] == [(2, 3)]


def test_deep_and_circular_taxonomies(spark):
    n = 150
    tax = [(1, 1, "no rank", "root")] + [(k, k - 1, "species" if k == n else "clade", f"t{k}") for k in range(2, n + 1)]
    tax += [(500, 501, "genus", "a"), (501, 500, "genus", "b"), (502, 500, "species", "c"), (600, 599, "species", "no parent"), (700, 700, "species", "own parent")]
    got = {r.taxid: r for r in taxonomy.lineages(spark.createDataFrame(tax, "taxid int, parent_taxid int, rank string, name string")).collect()}
    assert set(got) == set(range(1, n + 1))
    assert all(r.depth == t - 1 and [p.taxid for p in r.path] == list(range(1, t + 1)) for t, r in got.items())
    assert taxonomy.lineages(spark.createDataFrame(tax[1:], "taxid int, parent_taxid int, rank string, name string")).count() == 0


def test_mask_bins_against_all_regions(spark):
    rng = random.Random(1)
    width = hits.BIN
    regions = [("T", a, a + rng.choice([10, 400, 3 * width])) for a in (rng.randrange(8 * width) for _ in range(60))]
    spans = [(a, a + rng.randrange(0, 900)) for a in (rng.randrange(8 * width) for _ in range(400))] + [(width - 50, width + 50), (2 * width, 2 * width + 1)]
    h = spark.createDataFrame([("s", f"r{i}", "T", a, b, 10**6) for i, (a, b) in enumerate(spans)], "sample string, query string, target string, tstart int, tend int, tlen int")
    m = spark.createDataFrame(regions, "target string, start int, end int")
    for threshold in (0.5, 0.8, 0.1, 0.3):
        got = {r["query"]: r.is_masked for r in hits.label_masked_hits(h, m, threshold).collect()}
        assert got == {f"r{i}": b > a and any(max(min(b, y) - max(a, x), 0) >= threshold * (b - a) for _, x, y in regions) for i, (a, b) in enumerate(spans)}
    touched = sum(any(min(b, y) > max(a, x) for _, x, y in regions) for a, b in spans)
    assert hits.masked_read_count(h, m).first().masked_reads == touched


def test_coverage_stats_against_bases(spark):
    rng = random.Random(2)
    rows = [("s", f"r{i}", f"T{i % 4}", (a := rng.randrange(-20, 380)), a + rng.randrange(0, 90), 400) for i in range(120)]
    h = spark.createDataFrame(rows, "sample string, query string, target string, tstart int, tend int, tlen int")
    m = spark.createDataFrame([("T0", 100, 200), ("T1", 0, 50)], "target string, start int, end int")
    flags = {r["query"]: r.is_masked for r in hits.label_masked_hits(h, m).collect()}
    for r in coverage.coverage_stats(h, m).collect():
        for kind in ("total", "masked", "unmasked"):
            own = [x for x in rows if x[2] == r.target and (kind == "total" or flags[x[1]] == (kind == "masked"))]
            inside, wide = [p for *_, a, b, n in own for p in range(max(a, 0), min(b, n))], {p for *_, a, b, _ in own for p in range(a, b)}
            assert r[f"{kind}_hit_count"] == len(own) and r[f"{kind}_breadth_bp"] == len({*inside})
            assert r[f"{kind}_coverage_ratio"] == pytest.approx(min(1, len(wide) / 400)) and r[f"{kind}_avg_depth"] == pytest.approx(len(inside) / max(len({*inside}), 1))
        assert r.has_mask == (r.target in ("T0", "T1"))


def test_local_depth_against_bases(spark):
    rng = random.Random(3)
    rows = [(f"h{i}", "s", f"r{i % 20}", f"T{i % 3}", (a := rng.randrange(0, 300)), a + rng.randrange(1, 60), 400, 50.0) for i in range(90)]
    h = spark.createDataFrame(rows, "hit_id string, sample string, query string, target string, tstart int, tend int, tlen int, bits double")
    depth = {}
    for *_, t, a, b, _, _ in rows:
        for p in range(a, b):
            depth[t, p] = depth.get((t, p), 0) + 1
    got = {r.hit_id: r.local_depth for r in assign.local_depth_weights(h, intervals.depth_segments(h)).collect()}
    assert got == {i: pytest.approx(sum(depth[t, p] for p in range(a, b)) / (b - a)) for i, _, _, t, a, b, _, _ in rows}


def test_islands_with_depth(spark):
    rows = spark.createDataFrame([("A", "x", 0, 10), ("A", "x", 5, 15), ("A", "x", 15, 20), ("A", "x", 30, 40), ("B", "x", 3, 3)], "acc string, other string, start int, end int")
    assert {(r.start, r.end, r.n, r.mean_depth) for r in mask.merge_with_depth(rows).collect()} == {(0, 20, 3, 1.25), (30, 40, 1, 1.0)}


def test_fastq_in_small_splits(spark, tmp_path):
    """Splits that begin anywhere, qualities that begin with @ and +, an empty read, and records across several splits."""
    rng = random.Random(4)
    want, text = set(), ""
    for i in range(300):
        n = rng.choice([0, 1, 30, 400])
        seq, qual = "".join(rng.choice("ACGTN") for _ in range(n)), "".join(rng.choice("@+I5") for _ in range(n))
        want.add((f"r{i}", seq, qual))
        text += f"@r{i} lane 1\n{seq}\n+\n{qual}\n"
    (tmp_path / "s1_R1.fastq").write_text(text)
    (tmp_path / "none_R1.fastq").write_text("")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("97", "1500", "1000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            got = readers.read_fastq(spark, str(tmp_path)).collect()
            assert {(r.read_id, r.seq, r.qual) for r in got} == want and len(got) == 300, size
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_cache_is_used_while_newer(spark, tmp_path):
    import os

    path, cache = tmp_path / "s1_R1.tsv", str(tmp_path / "cache")
    line = "\t".join(["r1", "T1", "95.0", "80", "1", "80", "10", "90", "1e-9", "120.5", "100", "2000", "3001", "V", "x"]) + "\n"
    path.write_text(line)
    assert readers.read_hits_cached(spark, str(path), cache).count() == 1
    path.write_text(line + line.replace("r1", "r2"))
    os.utime(path, (1, 1))
    assert readers.read_hits_cached(spark, str(path), cache).count() == 1
    os.utime(path, (4e9, 4e9))
    assert readers.read_hits_cached(spark, str(path), cache).count() == 2


def test_order_of_results(spark, tmp_path):
    rows = spark.createDataFrame([("s", 5, 10, 1), ("s", 6, 30, 2), ("s", 7, 30, None), ("t", 5, 1, 0)], "sample string, working_taxid int, read_count int, depth int")
    assert {(r["sample"], r.working_taxid): r.line for r in writers.in_order(rows, "abundance").collect()} == {("s", 6): 1, ("s", 7): 2, ("s", 5): 3, ("t", 5): 1}
    writers.write_ordered(rows, str(tmp_path / "out"), "abundance")
    (part,) = (tmp_path / "out" / "sample=s").glob("*.csv")
    assert [x.split("\t")[0] for x in part.read_text().splitlines()] == ["working_taxid", "6", "7", "5"]
    clades = spark.createDataFrame([("s", 1, 9, 1), ("s", 2, 9, 0), ("s", 3, 20, 1), ("s", 4, 50, None)], "sample string, taxid int, reads int, depth int")
    assert [r.taxid for r in writers.in_order(clades, "clades").orderBy("line").collect()] == [2, 3, 1, 4]


DET = "cohort string, sample string, group string, taxid int, name string, reads int, weight double, genome_type string, is_phage boolean, host string, genus_name string"


@pytest.fixture(scope="module")
def detections(spark):
    rows = [("d", "a", "x", 1, "p1", 10, 1.0, "dsDNA", True, "Coli", "G"), ("d", "a", "x", 2, "p2", 30, 3.0, "dsDNA", True, None, "G"), ("d", "b", "x", 3, "v", 5, 2.0, "ssRNA", False, None, "H"), ("d", "b", "x", 1, "p1", 5, 2.0, "dsDNA", True, "Coli", "G")]
    return spark.createDataFrame(rows, DET)


def test_genome_types(spark, detections):
    manifest = spark.createDataFrame([("d", "a", "x"), ("d", "b", "x"), ("d", "c", "x")], "cohort string, sample string, group string")
    got = {r["sample"]: r for r in composition.genome_type_per_sample(detections, manifest).collect()}
    assert got["a"].dsDNA_reads == 40 and got["a"].dsDNA_species == 2 and got["b"].total_species == 2 and got["c"].total_reads == got["c"].RT_species == 0
    whole = {r.genome_type: r for r in composition.genome_type_per_cohort(detections).collect()}
    assert set(whole) == set(composition.GENOME_TYPES) and whole["RT"].reads == 0 and whole["ssRNA"].mean_share == 0.25 and whole["dsDNA"].read_share == 0.9


def test_matrices_by_level(spark, detections):
    manifest = spark.createDataFrame([("a",), ("b",), ("c",)], "sample string")
    of = lambda *a, **k: {(r["sample"], r.feature): r.value for r in composition.level_matrix(detections, manifest, *a, **k).collect() if r.value}
    assert of("kind") == {("a", "phage"): 40, ("b", "phage"): 5, ("b", "non-phage"): 5}
    assert of("combined_genus", "weight", share=True) == {("a", "Coli phage"): 0.25, ("a", "Other-host phage"): 0.75, ("b", "Coli phage"): 0.5, ("b", "H"): 0.5}
    assert composition.level_matrix(detections, manifest, "host_genus").count() == 3


def test_merged_tables_and_model(spark):
    tax = [(1, 1, "no rank", "root"), (10239, 1, "superkingdom", "Viruses"), (30, 10239, "genus", "G"), (40, 30, "species", "a"), (41, 30, "species", "b")]
    lineage = taxonomy.lineages(spark.createDataFrame(tax, "taxid int, parent_taxid int, rank string, name string"))
    assigned = spark.createDataFrame([("s", f"r{i}", 40 + i % 2, 1) for i in range(30)], "sample string, query string, lca_taxid int, read_count int")
    abundance = spark.createDataFrame([("s", 40, 15, 4e5), ("s", 41, 15, 6e5)], "sample string, working_taxid int, read_count int, tpm double")
    out = pipelines.merge_otu(assigned, lineage, assigned.select("sample"), min_count=1, abundance=abundance)
    assert {(r.taxid, r.value) for r in out["tpm_genus"].collect()} == {(30, 1e6)} and out["read_count_raw"].count() == 2
    rows = spark.createDataFrame([(f"s{i % 6}", i, float(i % 2), 100 if i % 2 else 10, 5, i % 2) for i in range(60)], "sample string, taxon int, both_frac double, total_reads int, unique_reads int, label int")
    for c in ("weighted_breadth", "unmasked_weighted_breadth", "multi_reads", "masked_reads", "unique_breadth_bp", "multi_breadth_bp", "avg_genome_length"):
        rows = rows.withColumn(c, F.lit(1.0))
    model, held = ml.train_tp_fp_model(ml.ml_features(rows))
    assert ml.score_tp_fp(model, ml.ml_features(rows)).where("accepted != (label = 1)").count() == 0 and held.where("auc < 1").count() == 0


def test_stages_are_dropped(spark, tmp_path, monkeypatch):
    import os

    from hitloom.functions import stage

    monkeypatch.setattr(stage, "RUN", "of-this-test")
    here = stage.own_dir(spark).removeprefix("file://")
    assert stage.stage(spark.range(5)).count() == 5 and os.listdir(here)
    stage.drop_stages(spark)
    assert not os.path.exists(here)


def test_fdr_over_many_ranges(spark):
    from hitloom.operators import cohort

    rng = random.Random(6)
    values = [rng.choice([0.01, 0.2, rng.random()]) for _ in range(400)] + [1.0, 0.0]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(900, None), (901, float("nan"))], "k int, p_value double")
    m = len(values)
    want = {i: min(1.0, *(v * m / sum(x <= v for x in values) for v in values if v >= p)) for i, p in enumerate(values)}
    assert {r.k: r.q_value for r in cohort.bh_fdr(rows.repartition(7)).collect()} == pytest.approx(want)
    assert {r.k: r.q_value for r in cohort.bh_fdr(rows.withColumn("g", F.lit(1)), by=("g",)).collect()} == pytest.approx(want)
    sizes = spark.createDataFrame([(f"s{i:02}", i * i) for i in range(30)], "sample string, size long")
    assert sorted(r["size"] for r in cohort.even_representatives(sizes.repartition(5), 4).collect()) == [0, 100, 361, 841]
