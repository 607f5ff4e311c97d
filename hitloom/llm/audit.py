"""Filter interaction audit: what each filter removes at each step of every order of the filters.

A document's mask has a bit for each filter that it fails. Documents are counted by part and mask: at most 32 cells a part,
so the orders are worked out on cells, whatever the number of documents. A recursive common table expression extends
prefixes of orders by each unused filter: a level joins the cells of its part, carries the applied filters as bits, and
emits the numbers of its step. Prefixes of five filters are the orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read

LETTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"

# {0} is the condition on a cell c, {1} the number that is summed up.
_SUM = "aggregate(filter(c.cells, c -> {0}), 0L, (sum, c) -> sum + c.{1})"
_KEPT, _HERE, _BEFORE = "c.mask & (s.applied | l.bit) = 0", "c.mask & l.bit != 0 AND c.mask & s.applied = 0", "c.mask & l.bit != 0 AND c.mask & s.applied != 0"
STEPS = f"""
WITH RECURSIVE letters(letter, bit) AS (VALUES {", ".join(f"('{c}', {1 << i})" for i, c in enumerate(LETTERS))}),
steps(part, filter_order, applied, emitted) AS (
  SELECT part, '', 0, CAST(array() AS array<struct<letter:string,kept:long,removed:long,redundant:long,unique_fails:long,good_lost:long,toxic_lost:long>>) FROM {{cells}}
  UNION ALL
  SELECT s.part, concat(s.filter_order, l.letter), s.applied | l.bit, array_append(s.emitted, named_struct(
    'letter', l.letter, 'kept', {_SUM.format(_KEPT, "n")}, 'removed', {_SUM.format(_HERE, "n")}, 'redundant', {_SUM.format(_BEFORE, "n")},
    'unique_fails', {_SUM.format("c.mask = l.bit", "n")}, 'good_lost', {_SUM.format(_HERE, "good")}, 'toxic_lost', {_SUM.format(_HERE, "toxic")}))
  FROM steps s JOIN letters l ON s.applied & l.bit = 0 JOIN {{cells}} c ON c.part = s.part
)
SELECT part, filter_order, emitted FROM steps WHERE length(filter_order) = {len(LETTERS)}
"""


def masked(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask of the filters A to D, digest of the text) of each document."""
    def of_words(words):
        n = F.size(words)
        return F.when(n < 100, 1).otherwise(0) + F.when(100 * F.size(F.array_distinct(words)) < 80 * n, 2).otherwise(0)

    docs = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    mask = F.transform(F.array(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))), of_words)[0]
    mask += F.when(100 * F.char_length(F.regexp_replace("text", "[^A-Z]+", "")) > 10 * F.char_length("text"), 4).otherwise(0)
    mask += F.when(F.col("text").rlike("[#$%&*|]"), 8).otherwise(0)
    return docs.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and filters failed; good and toxic are those labelled so.

    The first document of each text is found by digest and doc_id together, so the copies of a text don't meet in a task.
    """
    rows = cut(masked(docs))
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id IS NOT NULL").withColumn("first", F.lit(True))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(firsts, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    again = F.col("doc_id").isNotNull() & F.col("first").isNull()
    mask = F.col("mask") + F.when(again, 16).otherwise(0)
    return rows.groupBy("part", mask.alias("mask")).agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the numbers of that step, for every part (lang; null: empty) and order of ABCDE.

    A document fails A under 100 words, B if less than 80 % of its words are distinct, C if more than 10 % of its
    characters are A to Z, D if it holds one of #$%&*|, and E if a smaller doc_id has the same text, removed or not. Null
    texts count as empty; so an empty text fails A alone, or E too. Rows equal in text and doc_id are all firsts, or all copies; a null
    doc_id is neither smaller nor greater, so it never fails E and has no label. Of several labels of a doc_id, one is enough. Other columns, whatever their names,
    are left out. No documents: no parts, no rows.

    Spark ends recursions of many rows; here there are 326 for each part, so that limit is lifted while they are made.
    """
    spark = docs.sparkSession
    parts = cut(cells(docs.select("doc_id", "text", "lang"), labels.select("doc_id", "quality", "toxic")).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")))
    limit = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        orders = cut(spark.sql(STEPS, cells=parts))
    finally:
        spark.conf.unset(ROW_LIMIT) if limit is None else spark.conf.set(ROW_LIMIT, limit)
    steps = orders.select("part", "filter_order", F.posexplode("emitted").alias("at", "of")).select("part", "filter_order", (F.col("at") + 1).alias("step"), "of.*")
    shapley = steps.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return steps.join(shapley, ["part", "letter"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def op13_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five filters in all 120 orders over all documents, by language."""
    return audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


AUDIT_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM texts
),
marks AS (
  SELECT w.doc_id, part,
    (len(words) < 100)::INT AS a, (100 * len(list_distinct(words)) < 80 * len(words))::INT AS b,
    (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT AS c,
    regexp_matches(text, '[#$%&*|]')::INT AS d, coalesce(least < doc_id, false)::INT AS e
  FROM words w
),
labelled AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
docs AS (
  SELECT part, [a, b, c, d, e] AS fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM marks LEFT JOIN labelled USING (doc_id)
),
counted AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM docs GROUP BY part, fails),
n(i) AS (VALUES (1), (2), (3), (4), (5)),
orders AS (
  SELECT [v.i, w.i, x.i, y.i, z.i] AS o FROM n v, n w, n x, n y, n z WHERE len(list_distinct([v.i, w.i, x.i, y.i, z.i])) = 5
),
steps AS (SELECT o, n.i AS step, o[n.i] AS own, list_slice(o, 1, n.i - 1) AS earlier FROM orders, n),
sums AS (
  SELECT part, o, step, own,
    sum(CASE WHEN fails[own] = 0 AND hit = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN fails[own] = 1 AND hit = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails[own] = 1 AND hit > 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails[own] = 1 AND list_sum(fails) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fails[own] = 1 AND hit = 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN fails[own] = 1 AND hit = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM (SELECT c.*, s.*, coalesce(list_sum(list_transform(earlier, lambda k: fails[k])), 0) AS hit FROM counted c, steps s)
  GROUP BY part, o, step, own
)
SELECT part, array_to_string(list_transform(o, lambda k: substr('ABCDE', k, 1)), '') AS filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM sums
"""
