"""What the findings F22, F27 and F29 of the third round were about, on small tables."""

import math

from hitloom.operators import assign, em, evaluate, intervals
from hitloom.plans import q_hits


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_local_depth_shuffles_a_hit_twice(spark):
    plan = plan_of(q_hits.local_depth_weights(spark, "/root/testdata/sf0.001"))
    assert "Join" not in plan and plan.count("RepartitionByExpression") == 2
    executed = q_hits.local_depth_weights(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange ") == 2


def test_local_depth_equals_a_count_of_bases(spark):
    rows = [("s", "a", "T", "h1", 0, 10, 60.0), ("s", "a", "T", "h2", 5, 20, 80.0), ("s", "a", "T", "h2", 5, 20, 80.0), ("s", "b", "T", "h3", 30, 40, 50.0), ("s", "a", "U", "h4", 7, 9, 10.0)]
    odd = [("s", "a", "T", "h5", 3, 3, 9.0), ("s", "a", None, "h6", 3, 8, 9.0), (None, "a", "T", "h7", 3, 8, 9.0), ("s", "a", "T", "h8", 9, 8, 9.0), ("s", "a", "T", "h9", None, 8, 9.0)]
    hits = spark.createDataFrame(rows + odd, "sample string, query string, target string, hit_id string, tstart int, tend int, bits double")
    depth = {t: {b: sum(r[4] <= b < r[5] for r in rows if r[2] == t) for b in range(50)} for t in "TU"}
    mean = {t: sum(d.values()) / sum(x > 0 for x in d.values()) for t, d in depth.items()}
    local = {r[3]: sum(depth[r[2]][b] for b in range(r[4], r[5])) / (r[5] - r[4]) for r in rows}
    e = {r[3]: (r[1], math.exp(r[6] / 100 - abs(local[r[3]] - mean[r[2]]) / mean[r[2]])) for r in rows}
    want = {h: (local[h], x / sum(y for p, y in e.values() if p == q)) for h, (q, x) in e.items()}
    for runs in ([], [intervals.depth_segments(hits)]):
        got = [(r.hit_id, r.local_depth, r.weight) for r in assign.local_depth_weights(hits, *runs).collect()]
        assert len(got) == len(want) and all(abs(d - want[h][0]) < 1e-12 and abs(w - want[h][1]) < 1e-12 for h, d, w in got)
    assert assign.local_depth_weights(hits.limit(0)).count() == 0
    assert assign.local_depth_weights(hits, intervals.depth_segments(hits.limit(0))).count() == 0


def test_em_rounds_shuffle_no_class_and_assign_sorts_once(spark, monkeypatch):
    plans, real = [], em.stage
    monkeypatch.setattr(em, "stage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    rows = [("s", "a", 1, 9.0), ("s", "a", 2, 9.0), ("s", "b", 1, 5.0), ("s", "c", 3, 5.0), ("s", "d", 2, 9.0), ("s", "d", 1, 9.0), ("t", "a", 2, 0.0), ("t", "a", 4, 0.0)]
    more = [("u", f"x{i}", k, i + 1.0) for i in range(2000) for k in (1, 2)]  # classes of their own, larger than the shares
    cands = spark.createDataFrame(rows + more, "sample string, query string, species int, score double")
    share = em.em_abundance(cands, spark.createDataFrame([(1, 1000.0)], "species int, length double"), rounds=2, tolerance=0.0)
    assert len(plans) == 4 and sum("collect_list" in p for p in plans) == 1  # classes, species and two rounds; the classes are made in one table
    for p in plans[2:]:
        assert "InMemoryRelation" in p and "hashpartitioning(class" not in p.split("InMemoryRelation")[0]
    best = em.em_assign(cands, share)
    assert "Aggregate" not in plan_of(best)
    assert {(r["sample"], r["query"], r.species, round(r.posterior, 6), r.candidate_count) for r in best.where("sample != 'u'").collect()} == {("s", "a", 1, 0.777778, 2), ("s", "b", 1, 1.0, 1), ("s", "c", 3, 1.0, 1), ("s", "d", 1, 0.777778, 2), ("t", "a", 2, 0.5, 2)}
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_grid_deals_hits_out_once_and_counts_once(spark, monkeypatch):
    plans, real = [], evaluate.stage
    monkeypatch.setattr(evaluate, "stage", lambda df: plans.append(plan_of(df)) or real(df))
    rows = [("s", f"r{i}", t, f, n, b) for i in range(3) for t, f, n, b in [(1, 0.95, 60, 9.0), (2, 0.95, 60, 9.0), (3, 0.8, 90, 50.0), (4, None, 90, 60.0), (5, 0.99, 40, 70.0)]]
    hits = spark.createDataFrame(rows + [("s", "z", 3, 0.8, 90, 1.0)], "sample string, query string, taxid int, fident double, alnlen int, bits double")
    grid = spark.createDataFrame([("low", 0.7, 50), ("mid", 0.9, 50), ("short", 0.9, 30), ("none", 1.0, 50)], "cell string, min_identity double, min_length int")
    truth = spark.createDataFrame([("g", 1), ("h", 3)], "truth_group string, taxid int")
    got = {r.cell: (r.reads, r.taxa, r.tp, r.fp) for r in evaluate.parameter_grid(hits, grid, truth).collect()}
    assert got == {"low": (4, 1, 1, 0), "mid": (3, 1, 1, 0), "short": (3, 1, 0, 1)}
    assert len(plans) == 1 and plans[0].count("RepartitionByExpression") == 1 and plans[0].count("Aggregate") == 2
    assert evaluate.parameter_grid(hits, grid.limit(0), truth).count() == 0
