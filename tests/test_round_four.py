"""What the findings of the third round were about, on small tables."""

import os
import random

import pytest
from pyspark.sql import functions as F

from hitloom.operators import cohort, em, taxonomy
from hitloom.plans.catalog import QUERIES, SQL
from hitloom.sources import readers, writers

DATA = "/root/testdata/sf0.001"


def test_q_values_lose_no_row_when_p_is_computed_anew(spark):
    """Sums over shuffled rows may differ in the last bit from one evaluation to the next; here p differs wholly."""
    p = F.udf(lambda x: random.random(), "double").asNondeterministic()
    rows = spark.range(50).withColumn("p_value", p("id"))
    assert sorted(r.id for r in cohort.bh_fdr(rows).collect()) == list(range(50))


def test_sql_of_differential_abundance_takes_p_of_t_itself():
    inner = SQL["differential_abundance"].split("p AS (SELECT *")[0]
    assert "round(" not in inner.split("mat AS")[1]


def test_sql_of_islands_keeps_equal_intervals_together():
    """The one of two equal intervals that is new may be the second in the next window's order: here windows are computed by hand."""
    import duckdb

    from hitloom.plans.q_hits import islands_sql

    ctes = islands_sql("iv", "acc", "lo", "hi")
    rows = "iv AS (SELECT * FROM (VALUES ('a', 0, 5), ('a', 10, 12), ('a', 10, 12)) v(acc, lo, hi))"
    seen = ctes.replace("isl_n AS", "isl_m2 AS (SELECT acc, lo, hi, p FROM isl_m ORDER BY lo, hi, p DESC NULLS LAST), isl_n AS").replace("FROM isl_m)", "FROM isl_m2)")
    assert sorted(duckdb.sql(f"WITH {rows},{seen} SELECT * FROM isl").fetchall()) == [("a", 0, 5, 1), ("a", 10, 12, 2)]


def test_equal_posteriors_go_to_the_least_species(spark):
    """0.3 * 60 and 0.1 * 180 are equal but for the last bit."""
    cands = spark.createDataFrame([("s", "r", 1, 180.0), ("s", "r", 2, 60.0), ("s", "q", 1, 180.0), ("s", "q", 2, 61.0)], "sample string, query string, species int, score double")
    share = spark.createDataFrame([("s", 1, 0.1), ("s", 2, 0.30000000000000004)], "sample string, species int, a double")
    assert {(r["query"], r.species, round(r.posterior, 9), r.candidate_count) for r in em.em_assign(cands, share).collect()} == {("r", 1, 0.5, 2), ("q", 2, round(18.3 / 36.3, 9), 2)}


def test_of_several_rows_of_a_taxid_one_counts(spark):
    rows = [(1, 1, "no rank", "root"), (10239, 1, "superkingdom", "Viruses"), (5, 10239, "genus", "Gee"), (10239, 5, "species", "Aaa"), (7, 5, "species", "Zed"), (7, 5, "species", "Yed")]
    for part in (rows, rows[::-1]):
        t = spark.createDataFrame(part, "taxid int, parent_taxid int, rank string, name string").repartition(3)
        assert sorted((r.taxid, r.name, r.depth) for r in taxonomy.lineages(t).collect()) == [(1, "root", 0), (5, "Gee", 2), (7, "Yed", 3), (10239, "Viruses", 1)]
        assert taxonomy.verify_taxonomy(t).first().asDict() == {"taxa": 6, "has_root": True, "has_viruses": True, "unnamed": 0, "orphans": 0}
        levels = readers.relevel_report(t.selectExpr("'s' AS sample", "taxid AS line", "rank", "CASE name WHEN 'Aaa' THEN 4 ELSE 0 END AS depth"))
        assert [(r.rank_code, r.depth) for r in levels.where("line = 10239").orderBy("depth").collect()] == [("D", 0), ("S", 1)]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
def test_queries_equal_their_sql_where_a_species_has_the_taxid_of_viruses(spark, tmp_path):
    import duckdb

    con = duckdb.connect()
    for t in ("region", "nation", "supplier", "lineitem"):
        key = {"supplier": "s_suppkey", "lineitem": "l_suppkey"}.get(t)
        con.sql(f"COPY (SELECT * {f'REPLACE (({key} + 7236)::BIGINT AS {key})' if key else ''} FROM '{DATA}/{t}.parquet') TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    assert con.sql("SELECT count(*) FROM supplier WHERE 3000 + s_suppkey = 10239").fetchall() == [(1,)]
    for name in ("lineage", "subtree", "verify_taxonomy", "relevel_report", "source_taxonomy", "label_taxa"):
        df = QUERIES[name](spark, str(tmp_path))
        columns = sorted(df.columns)
        want = con.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
        assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == sorted(want, key=str), name


def test_matrix_is_read_back_whole_in_either_layout(spark, tmp_path, monkeypatch):
    otu = spark.createDataFrame([(s, t, t + k) for k, s in enumerate(["a", 'b,"x', "sample"]) for t in range(7) if t != k], "sample string, taxid int, value int").repartition(4)
    want = {(s, str(t)): str(0 if t == k else t + k) for k, s in enumerate(["a", 'b,"x', "sample"]) for t in range(7)}
    for size in (3, 7):
        monkeypatch.setattr(writers, "MATRIX_COLUMNS", size)
        path = str(tmp_path / f"by{size}")
        writers.write_matrix(otu, path, [])
        got = [((r["sample"], r.taxid), r.value) for r in readers.read_matrix(spark, path).collect()]
        assert len(got) == len(want) and dict(got) == want
    writers.write_matrix(otu.limit(0), str(tmp_path / "none"), [])
    assert readers.read_matrix(spark, str(tmp_path / "none")).count() == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "none")).columns == ["sample"]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
def test_matrix_of_many_taxa_equals_its_sql(spark, monkeypatch):
    import duckdb

    monkeypatch.setattr(writers, "MATRIX_COLUMNS", 4)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{DATA}/lineitem.parquet'")
    want = sorted(con.sql(f"SELECT sample, taxid, reads FROM ({SQL['sink_matrix']})").fetchall())
    assert sorted((r["sample"], r.taxid, r.reads) for r in QUERIES["sink_matrix"](spark, DATA).collect()) == want
