"""Hits, masks, taxonomies, references and cohorts derived from the given tables, by SQL that Spark and DuckDB read alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "hits": """
SELECT concat('s', CAST(l_orderkey % 4 AS STRING)) AS sample, concat('r', CAST(l_orderkey AS STRING)) AS query,
  concat('T', CAST(l_suppkey AS STRING), '_', CAST(l_partkey % 2 AS STRING)) AS target,
  CASE WHEN l_linenumber % 2 = 1 THEN '+' ELSE '-' END AS strand, 1.0 - l_discount AS fident,
  CAST(40 + floor(l_quantity) AS INT) AS alnlen, CAST((l_partkey * 37 + l_linenumber * 101) % 1990 AS INT) AS tstart,
  CAST((l_partkey * 37 + l_linenumber * 101) % 1990 + 40 + floor(l_quantity) AS INT) AS tend, l_tax * 0.02 AS evalue,
  CAST(50 + floor(l_extendedprice) % 60 AS DOUBLE) AS bits, CAST(100 + l_partkey % 5 AS INT) AS qlen, CAST(2000 AS INT) AS tlen,
  CAST(CASE WHEN l_partkey % 7 = 0 THEN 100000 + l_suppkey ELSE 3000 + l_suppkey END AS INT) AS taxid,
  concat(CAST(l_orderkey AS STRING), '.', CAST(l_partkey AS STRING), '.', CAST(l_linenumber AS STRING), '.', CAST(CAST(floor(l_extendedprice * 100) AS BIGINT) AS STRING)) AS hit_id
FROM {lineitem}""",
    "mask": """
SELECT concat('T', CAST(p_partkey % 100 AS STRING), '_', CAST(p_partkey % 2 AS STRING)) AS target,
  CAST((p_partkey * 13) % 1800 AS INT) AS lo, CAST((p_partkey * 13) % 1800 + p_size * 2 AS INT) AS hi FROM {part}""",
    "taxonomy": """
SELECT 1 AS taxid, 1 AS parent_taxid, 'no rank' AS rank, 'root' AS name
UNION ALL SELECT 10239, 1, 'superkingdom', 'Viruses'
UNION ALL SELECT CAST(100 + r_regionkey AS INT), 10239, 'family', r_name FROM {region}
UNION ALL SELECT CAST(200 + n_nationkey AS INT), CAST(100 + n_regionkey AS INT), 'genus', n_name FROM {nation}
UNION ALL SELECT CAST(3000 + s_suppkey AS INT), CAST(200 + s_nationkey AS INT), 'species', s_name FROM {supplier}
UNION ALL SELECT CAST(100000 + s_suppkey AS INT), CAST(3000 + s_suppkey AS INT), 'strain', concat(s_name, ' strain') FROM {supplier}""",
    "refs": """
SELECT concat('T', CAST(s_suppkey AS STRING), '_', CAST(k AS STRING)) AS accession, CAST(3000 + s_suppkey AS INT) AS taxid,
  CAST(1990 + 5 * k AS INT) AS length, concat('seg', CAST(k AS STRING)) AS segment_name, 1 AS is_segmented,
  CASE WHEN s_suppkey % 3 = 0 THEN concat(s_name, ' phage') WHEN s_suppkey % 11 = 1 THEN concat(s_name, ' partial') ELSE concat(s_name, ' virus') END AS title,
  CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE CAST(500000 + s_suppkey AS INT) END AS ictv_taxid,
  CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(3500 + (s_suppkey % 7) * 200 AS INT) END AS expected_genome_length
FROM {supplier} CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1) AS two""",
    "ictv": """
SELECT 499999 AS taxid, 499999 AS parent_taxid, 'realm' AS rank, 'Second root' AS name, CAST(NULL AS INT) AS ncbi_taxid, CAST(NULL AS STRING) AS molecule
UNION ALL SELECT CAST(490000 + n_nationkey AS INT), 499999, 'genus', concat('II ', n_name), NULL, NULL FROM {nation}
UNION ALL SELECT CAST(500000 + s_suppkey AS INT), CAST(490000 + s_nationkey AS INT), 'species', s_name,
  CASE WHEN s_suppkey % 2 = 0 THEN CAST(3000 + s_suppkey AS INT) END,
  CASE WHEN s_suppkey % 5 = 0 THEN 'dsDNA' WHEN s_suppkey % 5 = 1 THEN 'ssRNA(+)' WHEN s_suppkey % 5 = 2 THEN 'ssDNA(+/-)' END FROM {supplier}""",
    "metadata": """
SELECT concat('T', CAST(s_suppkey AS STRING), '_0') AS accession,
  CASE WHEN s_suppkey % 6 = 0 THEN 'Homo sapiens' WHEN s_suppkey % 9 = 0 THEN 'soil metagenome' WHEN s_suppkey % 4 = 0 THEN '' ELSE concat('Host', CAST(s_suppkey % 5 AS STRING), ' coli') END AS host FROM {supplier}""",
    "title_hosts": "SELECT concat('T', CAST(s_suppkey AS STRING), '_0') AS base_accession, concat('Titled', CAST(s_suppkey % 3 AS STRING)) AS host FROM {supplier} WHERE s_suppkey % 12 = 0",
    "counts": """
SELECT concat('c', CAST(l_orderkey % 24 AS STRING)) AS sample, CAST(3000 + l_suppkey AS INT) AS taxid, CAST(sum(floor(l_quantity)) AS BIGINT) AS reads
FROM {lineitem} WHERE (l_suppkey * 7 + l_orderkey % 24) % 5 <> 0 GROUP BY 1, 2""",
    "cohort": """
SELECT DISTINCT 'one' AS cohort, concat('c', CAST(o_orderkey % 24 AS STRING)) AS sample,
  CASE WHEN o_orderkey % 24 < 11 THEN 'control' ELSE 'case' END AS grp FROM {orders}""",
    "truth": "SELECT concat('g', CAST(s_suppkey % 12 AS STRING)) AS truth_group, CAST(3000 + s_suppkey AS INT) AS taxid FROM {supplier} WHERE s_suppkey % 4 = 0",
    "lengths": "SELECT CAST(3000 + s_suppkey AS INT) AS taxid, CAST(2000 + (s_suppkey % 17) * 500 AS BIGINT) AS length FROM {supplier} WHERE s_suppkey % 8 <> 0",
    "hsps": """
SELECT concat('chr', CAST(l_suppkey % 10 AS STRING)) AS hit, concat('V', CAST(l_partkey % 40 AS STRING)) AS query, CAST(100 + floor(l_quantity) * 4 AS INT) AS alen,
  80 + l_discount * 200 AS pid, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand,
  CAST(CASE WHEN l_linenumber % 2 = 0 THEN l_partkey % 3000 + 1 ELSE l_partkey % 3000 + 100 + floor(l_quantity) * 4 END AS INT) AS qf,
  CAST(CASE WHEN l_linenumber % 2 = 0 THEN l_partkey % 3000 + 100 + floor(l_quantity) * 4 ELSE l_partkey % 3000 + 1 END AS INT) AS qt,
  CAST(l_orderkey % 9000 + 1 AS INT) AS hf, CAST(l_orderkey % 9000 + 100 + floor(l_quantity) * 4 AS INT) AS ht
FROM {lineitem}""",
    "reads": """
SELECT source AS sample, 1 AS mate, CAST(doc_id AS STRING) AS read_id, text AS seq FROM {documents} WHERE text IS NOT NULL AND doc_id IS NOT NULL""",
    "host_texts": "SELECT concat('b', CAST(item_id AS STRING)) AS target, text AS seq FROM {benchmark} WHERE text IS NOT NULL",
}
def bases(x: str) -> str:
    """SQL for 256 bases that follow from a text."""
    return f"translate(concat({', '.join(f"md5(concat('{c}', {x}))" for c in 'abcdefgh')}), '0123456789abcdef', 'ACGTACGTACGTACGT')"


_N = "CAST(o_custkey % 40 AS STRING)"
VIEWS |= {
    "host_seqs": f"SELECT DISTINCT concat('chr', {_N}) AS target, {bases(_N)} AS seq FROM {{orders}}",
    # reads of the host on both strands, as they are, with an N or with a changed base, and others
    "dna_reads": f"""
SELECT concat('s', CAST(o_orderkey % 4 AS STRING)) AS sample, 1 AS mate, CAST(o_orderkey AS STRING) AS read_id,
  CASE o_custkey % 5 WHEN 0 THEN piece WHEN 1 THEN translate(reverse(piece), 'ACGT', 'TGCA') WHEN 2 THEN concat(substr(piece, 1, 30), 'N', substr(piece, 32))
    WHEN 3 THEN translate(reverse(concat(substr(piece, 1, 40), translate(substr(piece, 41, 1), 'ACGT', 'CGTA'), substr(piece, 42))), 'ACGT', 'TGCA') ELSE other END AS seq
FROM (SELECT o_orderkey, o_custkey, substr({bases(_N)}, CAST(1 + o_orderkey % 170 AS INT), 80) AS piece, substr({bases("concat('r', CAST(o_orderkey AS STRING))")}, 1, 80) AS other FROM {{orders}}) AS o""",
}
_TABLE = re.compile(r"\{(\w+)\}")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(_TABLE.findall(text))}
    return spark.sql(text, **tables).withColumnsRenamed({"lo": "start", "hi": "end", "grp": "group"})  # keywords in SQL


def oracle(names: str, query: str) -> str:
    """The query for DuckDB, with the named views as CTEs before it; further CTEs of the query follow after `WITH`."""
    head = ",\n".join(f"{n} AS ({_TABLE.sub(lambda m: m[1], VIEWS[n])})" for n in names.split())
    query = query.strip()
    return f"WITH RECURSIVE {head},\n{query[4:]}" if re.match(r"WITH\s", query) else f"WITH RECURSIVE {head}\n{query}"
