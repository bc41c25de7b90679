"""Cutting of plans between the steps of an iteration."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[str] = []


def _folder(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names; on a single machine one of our own will do."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="tessera-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df as a table written there, computed once; lost executors lose nothing of it. It is deleted when the driver ends."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _WRITTEN:
        atexit.register(_delete, spark)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is None:  # stopped already
        return
    for path in _WRITTEN:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
