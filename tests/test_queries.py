"""Every query against its SQL on the smallest tables, where they are there."""

import math
import os

import pytest

from hitloom.plans.catalog import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents benchmark labels".split()
# A few queries of each kind; the driver runs all of them.
NAMES = ["method_b", "best_hit", "label_masked_hits", "depth_segments", "lineage", "classify_lca", "paired_balanced", "segment_coverage", "clade_counts", "otu_at_rank", "host_map", "alpha_diversity", "mann_whitney_u", "score_detection", "kmer_seed", "trim_reads", "coverage_stats", "local_depth_weights", "source_fastq", "source_blast_xml", "report_round_trip", "genome_types_per_sample", "host_genus_composition", "lca_at_major_rank", "differential_abundance", "chained_hits", "report_parents", "hosts_by_rules", "mann_whitney_exact", "trim_adapter_edits", "label_masked_hits_thresholds", "merged_tables", "ml_filter_given_model", "source_fasta"]


def norm(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=str)
    want = con.sql(SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert got == sorted((tuple(norm(r[i]) for i in at) for r in want.fetchall()), key=str)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
