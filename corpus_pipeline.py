"""A training-data pipeline over `documents`: each stage calls one operator and hands its documents to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.llm import decontaminate, lines, pieces, simhash, toxicity
from hitloom.llm.common import cut, read

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine gives less than its threshold; null and empty texts stay."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("toxicity_score") < toxicity.THRESHOLD).select(COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines whose templates recur; n_chars follows the text."""
    out = lines.dedup_lines(docs)
    n_chars = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents unlike all lesser ones that stay: less than 0.8 of their five-word shingles shared. Of equal rows, one stays."""
    return simhash.one_of_each(docs).select(COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    found = decontaminate.find_leaks(docs, read(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks") == 0).select(COLUMNS)


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, text, ids and decoded of each document."""
    return pieces.encode(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding and decoding", piece_stage),
]

# The classifier, the template tree, the trie join, the edit-distance search and the tokenizer aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
