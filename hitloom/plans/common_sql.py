"""SQL that several oracles share; each is a list of CTEs to stand after the derived views."""

MASKED = """
hm AS (
  SELECT h.*, h.tend > h.tstart AND EXISTS (SELECT 1 FROM mask m WHERE m.target = h.target AND m.lo < m.hi
    AND greatest(least(h.tend, m.hi) - greatest(h.tstart, m.lo), 0) >= 0.5 * (h.tend - h.tstart)) AS is_masked FROM hits h
)"""
LINEAGE = """
one_taxon AS (
  SELECT taxid, parent_taxid, rank, name FROM (SELECT *, row_number() OVER (PARTITION BY taxid ORDER BY parent_taxid, rank, name) AS first_ FROM taxonomy) WHERE first_ = 1
), lin AS (
  SELECT taxid, rank, name, 0 AS depth, [taxid] AS ids, [rank] AS ranks, [name] AS names FROM one_taxon WHERE taxid = 1
  UNION ALL
  SELECT t.taxid, t.rank, t.name, l.depth + 1, list_append(l.ids, t.taxid), list_append(l.ranks, t.rank), list_append(l.names, t.name)
  FROM one_taxon t JOIN lin l ON t.parent_taxid = l.taxid WHERE t.taxid <> t.parent_taxid
), anc AS (
  SELECT taxid, unnest(ids) AS a, unnest(ranks) AS ar, unnest(names) AS an, unnest(range(len(ids))) AS d FROM lin
)"""
BEST = """
best AS (
  SELECT sample, query, arg_min(taxid, k) AS taxid, max(bits) AS bits, min(CASE WHEN k = 1 THEN fident END) AS fident, count(*) AS n_hits, count(DISTINCT taxid) AS n_unique_taxids
  FROM (SELECT *, row_number() OVER (PARTITION BY sample, query ORDER BY bits DESC, fident DESC, taxid) AS k FROM hits) GROUP BY sample, query
)"""


def rank_of(rank: str, name: str = "up") -> str:
    """taxid -> a, an: the ancestor at the rank."""
    return f"{name} AS (SELECT taxid, arg_max(a, d) AS a, arg_max(an, d) AS an FROM anc WHERE ar = '{rank}' GROUP BY taxid)"


def covered(source: str, by: str, out: str = "cov", lo: str = "tstart", hi: str = "tend") -> str:
    """by -> covered, the union length of the source's intervals."""
    return f"""
{out}_m AS (
  SELECT {by}, {lo} AS s, {hi} AS e, max({hi}) OVER (PARTITION BY {by} ORDER BY {lo}, {hi} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p
  FROM {source} WHERE {lo} < {hi}
), {out} AS (SELECT {by}, sum(greatest(0, e - greatest(s, coalesce(p, s)))) AS covered FROM {out}_m GROUP BY {by})"""


def runs(source: str, by: str, out: str = "runs") -> str:
    """by, lo, hi, depth of the source's (tstart, tend)."""
    return f"""
{out}_e AS (SELECT {by}, tstart AS pos, 1 AS d FROM {source} WHERE tstart < tend UNION ALL SELECT {by}, tend, -1 FROM {source} WHERE tstart < tend),
{out}_s AS (SELECT {by}, pos, sum(d) AS d FROM {out}_e GROUP BY {by}, pos HAVING sum(d) <> 0),
{out}_w AS (SELECT {by}, pos AS lo, sum(d) OVER (PARTITION BY {by} ORDER BY pos) AS depth, lead(pos) OVER (PARTITION BY {by} ORDER BY pos) AS hi FROM {out}_s),
{out} AS (SELECT * FROM {out}_w WHERE depth <> 0 AND hi IS NOT NULL)"""


def lca(sets: str, key: str, out: str = "lca") -> str:
    """sets (key, taxid) -> key, lca_taxid, n_taxids."""
    on = " AND ".join(f"x.{k.strip()} = n.{k.strip()}" for k in key.split(","))
    return f"""
{out}_k AS (SELECT DISTINCT {', '.join('s.' + k.strip() for k in key.split(','))}, s.taxid FROM {sets} s JOIN lin USING (taxid) WHERE s.taxid > 0),
{out}_n AS (SELECT {key}, count(*) AS n FROM {out}_k GROUP BY {key}),
{out}_x AS (SELECT {key}, a, d, count(*) AS c FROM {out}_k JOIN anc USING (taxid) GROUP BY {key}, a, d),
{out} AS (SELECT {', '.join('x.' + k.strip() for k in key.split(','))}, arg_max(x.a, x.d) AS lca_taxid, any_value(n.n) AS n_taxids FROM {out}_x x JOIN {out}_n n ON {on} WHERE x.c = n.n GROUP BY ALL)"""
