"""Parquet tables of one scale folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Schemas of single files, by path, length and time of the last change.
_SCHEMAS: dict[tuple[str, int, int], StructType] = {}


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table by name, with the schema it has now.

    A table of one file is opened for its schema once, and again when the file has changed;
    the time of a folder says nothing about its files, so its schema is read each time.
    """
    path = f"{base}/{name}.parquet"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.isFile(where):
        return spark.read.parquet(path)
    status = files.getFileStatus(where)
    key = (path, status.getLen(), status.getModificationTime())
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def register_views(spark: SparkSession, base: str, names: list[str]) -> None:
    """Temp views over the tables; nothing is read until a query runs."""
    for name in names:
        table(spark, base, name).createOrReplaceTempView(name)
