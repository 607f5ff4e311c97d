"""What the findings on growth of the third round were about, on small tables."""

import numpy as np
import pyarrow as pa

from hitloom.operators import cohort, ml
from hitloom.sources import readers


def cells(spark):
    rng = np.random.default_rng(3)
    rows = [(f"s{i}", f"f{j}", int(rng.poisson(5 + 4 * j * (i % 2)))) for i in range(9) for j in range(4)]
    groups = spark.createDataFrame([(f"s{i}", "xyx"[i % 3] if i < 8 else "other") for i in range(9)], "sample string, group string")
    return spark.createDataFrame(rows, "sample string, feature string, value int"), groups


def test_clr_effect_shuffles_no_draws(spark, monkeypatch):
    monkeypatch.setattr(cohort, "bh_fdr", lambda rows: rows)
    plan = cohort.clr_effect(*cells(spark), "x", "y", 16)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan


def test_clr_effect_equals_its_draws(spark):
    matrix, groups = cells(spark)
    draws = cohort.clr_draws(matrix, 16).join(groups, "sample").where("group in ('x', 'y')").withColumnRenamed("clr", "value")
    tests = {(r.feature, r.instance): r.p_value for r in cohort.mann_whitney(draws, ("feature", "instance"), "x", "y").collect()}
    rows = draws.collect()
    got = {r.feature: r for r in cohort.clr_effect(matrix, groups, "x", "y", 16).collect()}
    assert set(got) == {f"f{j}" for j in range(4)}
    for f, r in got.items():
        effects = []
        for k in range(16):
            a, b = (np.array([x.value for x in rows if (x.feature, x.instance, x.group) == (f, k, g)]) for g in "xy")
            effects.append((a.mean() - b.mean()) / np.sqrt((a.var(ddof=1) + b.var(ddof=1)) / 2))
        assert abs(r.effect - np.mean(effects)) < 1e-9
        assert abs(r.p_wilcoxon - np.mean([tests[f, k] for k in range(16)])) < 1e-9


def in_small_splits(spark, f):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        return f()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_blast_xml_is_read_in_splits(spark, tmp_path):
    hsp = "<Hsp>\n<Hsp_query-from>{0}</Hsp_query-from><Hsp_query-to>9</Hsp_query-to>\n<Hsp_hit-from>1</Hsp_hit-from><Hsp_hit-to>9</Hsp_hit-to><Hsp_identity>9</Hsp_identity>\n<Hsp_align-len>9</Hsp_align-len></Hsp>"
    one = "<Iteration>\n <Iteration_query-def>q{0} a &lt;virus&gt;</Iteration_query-def>\n<Iteration_hits><Hit><Hit_accession>h</Hit_accession><Hit_hsps>" + hsp * 2 + "</Hit_hsps></Hit></Iteration_hits>\n</Iteration>\n"
    (tmp_path / "a.xml").write_text('<?xml version="1.0"?>\n<BlastOutput><BlastOutput_iterations>\n' + "".join(one.format(i) for i in range(20)) + "</BlastOutput_iterations></BlastOutput>\n")

    def read():
        rows = readers.read_blast_xml(spark, str(tmp_path))
        return rows.rdd.getNumPartitions(), sorted((r["query"], r.qf) for r in rows.collect())

    parts, got = in_small_splits(spark, read)
    assert parts > 3 and got == sorted((f"q{i}", i) for i in range(20) for _ in range(2))


def test_fastq_records_leave_python_as_columns():
    lines = ["IIII", *(x for i in range(3) for x in (f"@r{i} lane", "ACGT", "+", "@III")), "@r3"]
    rows = [pa.RecordBatch.from_pydict({"value": lines[k : k + 5], "file": ["f"] * len(lines[k : k + 5]), "block": pa.array([0] * len(lines[k : k + 5]), pa.int64())}) for k in range(0, len(lines), 5)]
    whole, cut = ([r for b in readers._fastq_pieces(iter(rows), whole=w) for r in b.to_pylist()] for w in (True, False))
    assert [(r["head"], r["seq"], r["qual"], r["lines"]) for r in whole] == [(f"@r{i} lane", "ACGT", "@III", None) for i in range(3)]
    assert [(r["part"], r["lines"]) for r in cut] == [(0, ["IIII"]), (1, ["@r3"])]


def test_fasta_is_parsed_once_for_whole_records(spark, tmp_path):
    records = [(f"r{i} >x", "ACGT" * (i % 4)) for i in range(60)]
    (tmp_path / "a.fa").write_text("".join(f">{h}\r\n{s[:5]}\n {s[5:]}\n\n" for h, s in records))

    def read():
        out = readers.read_fasta(spark, str(tmp_path))
        return out._jdf.queryExecution().optimizedPlan().toString(), sorted((r.header, r.seq) for r in out.collect())

    plan, got = in_small_splits(spark, read)
    assert got == sorted(records)
    assert plan.count("MapInArrow") <= 4  # one for whole records; the others give out what is cut alone


def test_a_model_without_scores_is_fitted_once(spark, monkeypatch):
    fits = []
    pipeline = ml._pipeline
    monkeypatch.setattr(ml, "_pipeline", lambda: fits.append(1) or pipeline())
    rows = spark.createDataFrame([(f"s{i % 8}", i % 2, *(float((i * (k + 3) + i % 2 * k) % 11) for k in range(len(ml.FEATURES)))) for i in range(40)], ["sample", "label", *ml.FEATURES])
    one = ml.coefficients(ml.fit_tp_fp_model(rows))
    assert len(fits) == 1
    both = ml.coefficients(ml.train_tp_fp_model(rows, 1)[0])
    assert all(abs(one[f] - both[f]) < 1e-6 for f in ml.FEATURES)
