"""Delimited files whose columns and types drift from file to file, read under one schema.

Types widen along ``int < bigint < double < string``; ``boolean``, ``date`` and ``timestamp``
(which takes in dates) stand beside the numbers, and two that differ meet in ``string``. Every
value of every file is looked at, in one pass of partial aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.sources.files import list_files
from churnlake.streaming.arrivals import _first_lines, _quoted, header_names

_FILE = "source_file"
# One bit a kind of value. A column's kinds are their sum, whatever the order of files.
KINDS = {"boolean": 1, "int": 2, "bigint": 4, "double": 8, "date": 16, "timestamp": 32, "string": 64}
_LADDERS = (("int", "bigint", "double"), ("date", "timestamp"), ("boolean",))
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INTEGER = r"^[+-]?[0-9]+$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$"


def widened(kinds: int) -> str:
    """Narrowest type that holds all the kinds; no value at all, or kinds of two ladders, is text."""
    for ladder in _LADDERS:
        if kinds and not kinds & ~sum(KINDS[k] for k in ladder):
            return [k for k in ladder if kinds & KINDS[k]][-1]
    return "string"


def _kind(c: Column) -> Column:
    """Kind of one value; an empty one has none. Whole numbers past ``bigint`` are text, since
    ``double`` would lose digits."""
    kind = (
        F.when(c.isNull() | (c == ""), 0)
        .when(F.lower(c).isin("true", "false"), KINDS["boolean"])
        .when(c.rlike(_INTEGER) & c.try_cast("int").isNotNull(), KINDS["int"])
        .when(c.rlike(_INTEGER) & c.try_cast("bigint").isNotNull(), KINDS["bigint"])
        .when(c.rlike(_NUMBER) & ~c.rlike(_INTEGER) & c.try_cast("double").isNotNull(), KINDS["double"])
        .when(c.rlike(_DATE) & c.try_cast("date").isNotNull(), KINDS["date"])
        .when(c.rlike(_TIME) & c.try_cast("timestamp_ntz").isNotNull(), KINDS["timestamp"])
    )
    return kind.otherwise(KINDS["string"])


def _clean(names: Sequence[str]) -> list[str]:
    """Lower case with ``_``; a name that is taken gets a number, so no column is lost."""
    out: list[str] = []
    for i, name in enumerate(names):
        name = name.lower().replace(" ", "_")
        while name in (*out, _FILE):
            name = f"{name}_{i}"
        out.append(name)
    return out


@dataclass
class Drift:
    """What the files of a folder hold: ``columns`` is ``(name, type, filled, files)`` in the order
    in which they are first met by path, with the files that have rows, and ``groups`` the text rows of each distinct header."""

    spark: SparkSession
    columns: list[tuple[str, str, int, int]]
    groups: list[DataFrame]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T._parse_datatype_string("timestamp_ntz" if t == "timestamp" else t)) for n, t, *_ in self.columns])

    def table(self) -> DataFrame:
        """The columns as rows."""
        return self.spark.createDataFrame(self.columns, "name string, type string, filled bigint, files bigint")

    def read(self) -> DataFrame:
        """Rows of all files under the one schema, with ``source_file``. A column that a file
        does not have is null there, and so is an empty field. Files are not looked at again
        for types: a value that changed since and no longer fits is an error, not a null."""
        out = self.spark.createDataFrame([], T.StructType([T.StructField(_FILE, T.StringType()), *self.schema.fields]))
        for rows in self.groups:
            typed = [F.nullif(_quoted(f.name), F.lit("")).cast(f.dataType).alias(f.name) for f in self.schema if f.name in rows.columns]
            out = out.unionByName(rows.select(_FILE, *typed), allowMissingColumns=True)
        return out


def schema_of_files(spark: SparkSession, path: str, pattern: str = "*.csv") -> Drift:
    """One schema for all files below a path, each under its own header at any width.

    Files with the same header are one read; the kinds of all values of all columns come from
    one job, a row for each file and column. The driver gets file names, headers and that
    many sums. A folder without files, or with headers only, gives no rows and text columns.
    """
    paths = [r["path"] for r in list_files(spark, path, pattern).select("path").collect()]
    lines = _first_lines(spark, paths) if paths else {}
    bad = sorted(p for p, (_, sound) in lines.items() if not sound)
    if bad:
        raise ValueError(f"not UTF-8: {', '.join(bad[:5])}{' ...' if len(bad) > 5 else ''}")
    headers: dict[tuple[str, ...], list[str]] = {}
    for file, (line, _) in sorted(lines.items()):
        headers.setdefault(tuple(_clean(header_names(line, ()))), []).append(file)
    groups, sums = [], []
    for names, found in headers.items():
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        rows = spark.read.schema(text).option("header", True).option("multiLine", True).option("escape", '"').csv(found)
        rows = rows.select(F.col("_metadata.file_path").alias(_FILE), *[F.trim(_quoted(n)).alias(n) for n in names])
        groups.append(rows)
        marks = [
            F.struct(F.lit(n).alias("name"), F.bit_or(_kind(_quoted(n))).alias("kinds"), F.count_if(_kind(_quoted(n)) > 0).alias("filled"))
            for n in names
        ]
        sums.append(rows.groupBy(_FILE).agg(F.array(*marks).alias("m")).select(F.inline("m")))
    held: dict[str, tuple[int, int, int]] = {n: (0, 0, 0) for names in headers for n in names}
    if sums:
        per_name = reduce(DataFrame.union, sums).groupBy("name").agg(
            F.bit_or("kinds").alias("kinds"), F.sum("filled").alias("filled"), F.count(F.lit(1)).alias("files")
        )
        held.update({r["name"]: (r["kinds"], r["filled"], r["files"]) for r in per_name.collect()})
    return Drift(spark, [(n, widened(k), filled, files) for n, (k, filled, files) in held.items()], groups)
