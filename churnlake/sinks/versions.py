"""Versioned Parquet folders.

A version is written beside the current one and becomes visible when one small row naming
it is appended to the log, so readers see either the old or the new version and the path
being read is never overwritten. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "version bigint, path string"


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _current(spark: SparkSession, root: str) -> tuple[int, str | None]:
    files, log = _file_system(spark, f"{root}/_log")
    if not files.exists(log):
        return 0, None
    row = spark.read.schema(_LOG).json(f"{root}/_log").agg(F.max("version").alias("v"), F.max_by("path", "version").alias("p")).first()
    return row["v"] or 0, row["p"]


def stage(df: DataFrame, root: str) -> str:
    """Write a version without publishing it; returns its path."""
    path = f"{root}/data-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged version that is not to be published."""
    files, where = _file_system(spark, path)
    files.delete(where, True)


def publish(spark: SparkSession, root: str, path: str) -> int:
    """Make a staged version the current one."""
    version = _current(spark, root)[0] + 1
    spark.createDataFrame([(version, path)], _LOG).coalesce(1).write.mode("append").json(f"{root}/_log")
    return version


def read_current(spark: SparkSession, root: str) -> DataFrame:
    version, path = _current(spark, root)
    if path is None:
        raise FileNotFoundError(f"no published version under {root}")
    return spark.read.parquet(path)
