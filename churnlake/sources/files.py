"""Delimited files, JSON documents and folder listings."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

CORRUPT = "_corrupt_record"


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Types inferred, which costs a second scan; fix the schema for large inputs."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_csv_schema(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Declared schema. The header is checked against it, so columns in another order are
    an error and not silently shifted values."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_csv_tolerant(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    quoted_newlines: bool = True,
    header: bool = True,
) -> DataFrame:
    """Rows with missing trailing columns are kept with nulls; the raw line of a malformed
    row is in ``_corrupt_record``. Quoted newlines make each file one unsplit read."""
    full = T.StructType.fromDDL(schema) if isinstance(schema, str) else T.StructType(list(schema.fields))
    full.add(CORRUPT, "string")
    return (
        spark.read.schema(full)
        .option("header", header)
        .option("multiLine", quoted_newlines)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def read_json_documents(
    spark: SparkSession, path: str, items: str, schema: str | None = None, one_per_file: bool = True
) -> DataFrame:
    """Payload documents ``{..., items: [...]}`` to one row per item, keeping the envelope.

    A file holds one document over several lines, or, for large inputs that should split,
    one document per line.
    """
    reader = spark.read.option("multiLine", one_per_file)
    docs = (reader.schema(schema) if schema else reader).json(path)
    envelope = [c for c in docs.columns if c != items]
    return docs.select(*[F.col(c).alias(f"doc_{c}") for c in envelope], F.inline(items))


def read_or_empty(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """CSV with a declared schema; a missing path is logged and gives no rows."""
    try:
        return read_csv_schema(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log.error("File not found: %s", path)
        return spark.createDataFrame([], schema)


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of every file below a folder; no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "modificationTime", "length")
    )


def latest_file(spark: SparkSession, root: str, pattern: str = "*.csv") -> str | None:
    """Newest file below a folder; the path breaks a tie."""
    newest = F.max_by("path", F.struct("modificationTime", "path"))
    return list_files(spark, root, pattern).agg(newest.alias("path")).first()["path"]


def latest_drop(spark: SparkSession, root: str, pattern: str = "*.csv") -> str | None:
    """Folder of the newest file below a folder: a drop of any number of files."""
    newest = latest_file(spark, root, pattern)
    return newest.rsplit("/", 1)[0] if newest else None


def read_all_under_prefix(
    spark: SparkSession, root: str, schema: str | T.StructType, pattern: str = "*.csv"
) -> DataFrame:
    """Every matching file below a folder as one frame."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .csv(root)
    )


def lake_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Objects and bytes per top folder."""
    inside = F.regexp_replace("path", "^[a-z0-9]+:/*", "/")
    base = "/" + root.split(":", 1)[-1].strip("/") + "/"
    below = F.substring_index(F.expr("_path").substr(F.lit(len(base) + 1), F.length("_path")), "/", 1)
    return (
        list_files(spark, root)
        .withColumn("_path", inside)
        .groupBy(below.alias("folder"))
        .agg(F.count(F.lit(1)).alias("objects"), F.sum("length").alias("bytes"))
    )


# Inferred types that are kept; every other type becomes text.
SAMPLE_TYPES = ("int", "bigint", "double")


def schema_from_sample(spark: SparkSession, file: str) -> T.StructType:
    """Schema fixed from one file: lower-case names with ``_``, flags and unknown types as text."""
    seen = spark.read.csv(file, header=True, inferSchema=True).schema
    out = T.StructType()
    for f in seen.fields:
        kept = f.dataType if f.dataType.simpleString() in SAMPLE_TYPES else T.StringType()
        out.add(f.name.lower().replace(" ", "_"), kept)
    return out
