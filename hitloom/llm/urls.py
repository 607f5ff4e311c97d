"""URL filters: fixed host rules, and for all other urls a tree of path templates judged by labelled purity.

Everything is a DataFrame expression. A url's path is cut into segments; numbers become wildcards at once, so that the
tree is grown over distinct (host, shape) rows with counts instead of over urls. Level by level, to the end of every
path, a segment becomes a wildcard if its node has more than MAX_CHILDREN children and the segment has less than an even
share of the node's urls. Segments that all shapes below a node share are taken in one step, and a node with no more
than MAX_CHILDREN shapes is finished, as no wildcard can come below it; so there are as many rounds as a path has places
where many shapes part. Templates of a host that differ only in literal segments are merged where their labelled share of
good pages doesn't differ from that of all of them (|z| <= Z). A template is blocked if its smoothed purity,
(good + SMOOTH * prior) / (labelled + SMOOTH), is below MIN_PURITY; prior is the good share of all labelled pages.

A page's label is that of the document whose number ends its path; it is good if its quality is 1 and it isn't toxic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read

MAX_CHILDREN, Z, SMOOTH, MIN_PURITY = 8, 1.96, 10, 0.6
SALTS = 1024
# Verdict, host, path prefix.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without `://`."""
    there = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.regexp_extract(url, "(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.when(there, host).otherwise(""), F.when(there, path).otherwise("")


def rule_of(host: Column, path: Column) -> Column:
    """struct(rule, verdict) of the longest rule that fits host or a domain above it and the path's start; else null."""
    out = None
    for verdict, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def shape_of(path: Column) -> Column:
    """The path's segments, with each number a `*`."""
    return F.filter(F.split(F.regexp_replace(path, "[0-9]+", "*"), "/"), lambda s: s != "")


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """pages (page_id, url) -> page_id, host, path, shape, good (1, 0, or null where the page has no label)."""
    host, path = host_and_path(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    number = F.regexp_extract("path", "([0-9]{1,18})[^0-9/]*/?$", 1)
    pages = pages.select("*", shape_of(F.col("path")).alias("shape"), F.when(number != "", number.cast("long")).alias("doc_id"))
    good = labels.where("quality is not null or toxic is not null").groupBy("doc_id").agg(
        F.min(((F.coalesce("quality", F.lit(1)) == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")).alias("good")
    )
    # pages without a number match no label; a salt deals them out
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS))).otherwise(0)
    return pages.withColumn("salt", salt).join(good.withColumn("salt", F.lit(0).cast("long")), ["doc_id", "salt"], "left").drop("doc_id", "salt")


def path_templates(shapes: DataFrame) -> DataFrame:
    """(host, shape, n, labelled, good) -> the same rows with `template`, the shape's segments after generalisation."""
    columns = ["host", "shape", "n", "labelled", "good", "template"]
    open_ = shapes.withColumn("template", F.array().cast("array<string>")).withColumn("rest", F.col("shape"))
    done = []
    while True:
        # the segments that all shapes of a node share are those that its least and its greatest one share
        nodes = open_.groupBy("host", "template").agg(F.count("*").alias("shapes"), F.min("rest").alias("x"), F.max("rest").alias("y"))
        same = F.concat(F.zip_with("x", "y", lambda a, b: a.eqNullSafe(b)), F.array(F.lit(False)))
        nodes = nodes.select("host", "template", "shapes", (F.array_position(same, F.lit(False)) - 1).cast("int").alias("shared"))
        rows = open_.join(nodes, ["host", "template"])
        taken = F.when(F.col("shapes") <= MAX_CHILDREN, F.size("rest")).otherwise(F.col("shared"))
        rows = cut(
            rows.withColumn("taken", taken)
            .withColumn("template", F.concat("template", F.slice("rest", F.lit(1), F.col("taken"))))
            .withColumn("rest", F.slice("rest", F.col("taken") + 1, F.size("rest")))
            .select(*columns, "rest", (F.col("shapes") > MAX_CHILDREN).alias("many"))
        )
        done.append(rows.where("not many").select(columns))
        rows = rows.where("many").drop("many").withColumn("segment", F.get("rest", F.lit(0)))
        if rows.isEmpty():
            return reduce(DataFrame.unionByName, done)
        children = cut(rows.groupBy("host", "template", "segment").agg(F.sum("n").alias("own")))
        nodes = children.groupBy("host", "template").agg(F.count("segment").alias("children"), F.sum("own").alias("all"))
        rare = (F.col("children") > MAX_CHILDREN) & (F.col("own") * F.col("children") < F.col("all"))
        to = children.where("segment is not null").join(nodes, ["host", "template"]).select("host", "template", "segment", F.when(rare, "*").otherwise(F.col("segment")).alias("to"))
        done.append(rows.where("segment is null").select(columns))  # these paths end here
        grown = rows.join(to, ["host", "template", "segment"])
        open_ = cut(grown.withColumn("template", F.concat("template", F.array("to"))).select(*columns, F.slice("rest", F.lit(2), F.size("rest")).alias("rest")))


def good_share(shapes: DataFrame) -> float:
    """The share of good pages among all labelled ones; 1 without labels."""
    return shapes.agg(F.coalesce(F.try_divide(F.sum("good").cast("double"), F.sum("labelled")), F.lit(1.0))).first()[0]


def judged(shapes: DataFrame, prior: float) -> DataFrame:
    """(host, shape, ...) of path_templates() -> host, shape, template (as text, after merging), purity, method_verdict."""
    text = F.concat(F.lit("/"), F.array_join("template", "/"))
    rows = shapes.select("host", "shape", text.alias("template"), F.regexp_replace(text, "[^/]+", "*").alias("merged"), "labelled", "good")
    own = rows.groupBy("host", "merged", "template").agg(F.sum("labelled").alias("l"), F.sum("good").alias("g"))
    pooled = own.groupBy("host", "merged").agg(F.sum("l").alias("pl"), F.sum("g").alias("pg"))
    share, all_ = F.try_divide(F.col("g").cast("double"), F.col("l")), F.try_divide(F.col("pg").cast("double"), F.col("pl"))
    alike = F.coalesce((share - all_) * (share - all_) * F.col("l") <= Z * Z * all_ * (1 - all_), F.lit(True))
    kept = own.join(pooled, ["host", "merged"]).select("host", "template", F.when(alike, F.col("merged")).otherwise(F.col("template")).alias("final"), "l", "g")
    purity = (F.col("fg") + F.lit(SMOOTH * prior)) / (F.col("fl") + SMOOTH)
    final = kept.groupBy("host", "final").agg(F.sum("l").alias("fl"), F.sum("g").alias("fg")).select("host", "final", purity.alias("purity"))
    out = rows.select("host", "shape", "template").join(kept.select("host", "template", "final"), ["host", "template"]).join(final, ["host", "final"])
    return out.select("host", "shape", F.col("final").alias("template"), "purity", F.when(F.col("purity") < MIN_PURITY, "block").otherwise("allow").alias("method_verdict"))


def judge_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of each page.

    A null url or one without `://` has an empty host and path, which form a template of their own. Repeated rows stay;
    extra columns are left out. Without labels every template has purity 1.
    """
    rows = cut(page_labels(pages, labels))
    shapes = rows.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("good").alias("labelled"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    shapes = cut(shapes)
    verdicts = cut(judged(path_templates(shapes), good_share(shapes)))
    rule = rule_of(F.col("host"), F.col("path"))
    return rows.join(verdicts, ["host", "shape"]).withColumn("r", rule).select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", "method_verdict").alias("verdict"), "template", "purity"
    )


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict; a null url or one without `://` has an empty host and path. Repeated rows stay; other columns aren't read."""
    return judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"), read(spark, sf_dir, "labels"))


_RULES = "\n".join(
    f"    WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p}'"
    for _, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
)
_VERDICTS = "\n".join(f"    WHEN rule = '{h + p}' THEN '{v}'" for v, h, p in RULES)
URL_SQL = f"""
WITH RECURSIVE cutup AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cutup
), shaped AS (
  SELECT *, list_filter(string_split(regexp_replace(path, '[0-9]+', '*', 'g'), '/'), lambda s: s <> '') AS segments,
    nullif(regexp_extract(path, '([0-9]{{1,18}})[^0-9/]*/?$', 1), '')::BIGINT AS doc_id FROM parsed
), pure AS (
  SELECT doc_id, min((coalesce(quality, 1) = 1 AND coalesce(toxic, 0) = 0)::INT) AS good FROM labels
  WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id
), page AS (
  SELECT s.page_id, s.host, s.path, segments AS shape, p.good
  FROM shaped s LEFT JOIN pure p ON s.doc_id = p.doc_id
), grown AS (
  SELECT host, shape, count(*) AS n, count(good) AS labelled, coalesce(sum(good), 0) AS good, '' AS template, 0 AS level FROM page GROUP BY host, shape
  UNION ALL
  SELECT host, shape, n, labelled, good,
    template || CASE WHEN segment IS NULL THEN '' WHEN children > {MAX_CHILDREN} AND own * children < everything THEN '/*' ELSE '/' || segment END, level + 1
  FROM (
    SELECT *, shape[level + 1] AS segment,
      sum(n) OVER (PARTITION BY host, template, shape[level + 1]) AS own,
      count(DISTINCT shape[level + 1]) OVER (PARTITION BY host, template) AS children,
      sum(n) OVER (PARTITION BY host, template) AS everything
    FROM grown WHERE level <= len(shape)
  )
), texts AS (
  SELECT host, shape, labelled, good, CASE WHEN template = '' THEN '/' ELSE template END AS template FROM grown WHERE level = len(shape) + 1
), merged AS (
  SELECT *, regexp_replace(template, '[^/]+', '*', 'g') AS merged FROM texts
), prior AS (SELECT coalesce(sum(good)::DOUBLE / nullif(sum(labelled), 0), 1.0) AS prior FROM texts),
own AS (SELECT host, merged, template, sum(labelled) AS l, sum(good) AS g FROM merged GROUP BY ALL),
pooled AS (SELECT host, merged, sum(l) AS pl, sum(g) AS pg FROM own GROUP BY ALL),
shares AS (
  SELECT host, template, merged, l, g, g::DOUBLE / nullif(l, 0) AS share, pg::DOUBLE / nullif(pl, 0) AS everything FROM own JOIN pooled USING (host, merged)
), kept AS (
  SELECT host, template, l, g, CASE WHEN coalesce((share - everything) * (share - everything) * l <= {Z} * {Z} * everything * (1 - everything), true) THEN merged ELSE template END AS final FROM shares
), final AS (
  SELECT host, final, (sum(g) + {SMOOTH} * prior) / (sum(l) + {SMOOTH}) AS purity FROM kept, prior GROUP BY host, final, prior
), ruled AS (
  SELECT p.page_id, p.host, p.path, p.shape, CASE
{_RULES}
    END AS rule FROM page p
)
SELECT r.page_id, r.host, r.path, r.rule, CASE
{_VERDICTS}
    WHEN f.purity < {MIN_PURITY} THEN 'block' ELSE 'allow' END AS verdict, k.final AS template, f.purity AS purity
FROM ruled r JOIN texts x ON r.host = x.host AND r.shape = x.shape
JOIN kept k ON x.host = k.host AND x.template = k.template
JOIN final f ON k.host = f.host AND k.final = f.final
"""
