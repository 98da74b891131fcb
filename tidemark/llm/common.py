"""Tables, columns and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(df: DataFrame, *cols: str) -> DataFrame:
    """The named columns only. Names are matched exactly and by position, so that extra columns
    whose names differ in case alone, hold dots or clash with an operator's own names do no harm."""
    names = df.columns
    tmp = df.toDF(*[f"_tm{i}" for i in range(len(names))])
    return tmp.select(*[F.col(f"_tm{names.index(c)}").alias(c) for c in cols])


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or in local mode alone, where it is
    unset, one of our own."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and read from the shared folder from now on."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_dir(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def drop_dir(spark: SparkSession, path: str) -> None:
    """Deletes a folder of ours, on whatever file system it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
