"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; where it is unset, a temporary folder if Spark runs in one process, else an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="spark-shared-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write and read again: cuts lineage, and outlives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
