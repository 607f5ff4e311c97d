"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import hitloom
from hitloom.functions.stage import stage as cut  # noqa: F401  a table in the shared folder: computed once, and lineage ends there

# Functions of the package travel to the executors by value, so a cluster needs no installed copy.
cloudpickle.register_pickle_by_value(hitloom)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def learnable(doc_id: str = "doc_id"):
    """True for the rows that labels may be learnt from: crc32(doc_id as text) mod 3 is not 1."""
    return F.crc32(F.col(doc_id).cast("string")) % 3 != 1


def held_out(doc_id: str = "doc_id"):
    """True for held-out rows; a null doc_id is in neither part and counts as not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def with_fields(df: DataFrame, ddl: str) -> StructType:
    """df's schema and the fields of ddl after it."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])
