"""Stages of long plans as tables: computed once, and lineage and plan end there."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

RUN = uuid.uuid4().hex  # of this driver process: its tables stand in a folder of their own


@cache
def _temporary() -> str:
    return "file://" + tempfile.mkdtemp(prefix="hitloom-")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset (tests, a single machine), a folder of this driver's own."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return where or _temporary()


def own_dir(spark: SparkSession) -> str:
    """This driver's own folder in the shared one."""
    return f"{shared_dir(spark)}/hitloom-{RUN}"


def stage(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back. The table stays until drop_stages(): results may still be lazy."""
    path = f"{own_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession) -> None:
    """Delete all tables that stage() has written in this driver; to be called when results have been written or collected."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(own_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
