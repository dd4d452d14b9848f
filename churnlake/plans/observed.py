"""Writes that measure what they write.

A frame is written to a staging path and its metrics are aggregated by the tasks of that
same write (``DataFrame.observe``), so the source is computed once. What the metrics decide
comes after: a version that fails the gate is deleted and no reader ever sees it.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from churnlake.operators.quality import is_blank
from churnlake.sinks import versions


def staged(df: DataFrame, root: str, metrics: Mapping[str, Column]) -> tuple[str, dict[str, Any]]:
    """Write ``df`` as a version of ``root`` that is not published; its path and the metrics.

    Metrics are aggregates without DISTINCT. A task that runs twice counts once, since they
    are taken in the last stage, that of the write.
    """
    seen = Observation()
    columns = [c.alias(name) for name, c in metrics.items()]
    path = versions.stage(df.observe(seen, *columns), root)
    return path, seen.get


def check_metrics(key: str, rules: Mapping[str, Column]) -> dict[str, Column]:
    """Metrics of the quality checks that need no second look at the rows."""
    return {
        "total_records": F.count(F.lit(1)),
        "null_ids": F.count_if(is_blank(key)),
        **{name: F.count_if(cond) for name, cond in rules.items()},
    }


def repeated_keys(written: DataFrame, key: str) -> DataFrame:
    """``duplicate_ids, surplus_rows`` from the key column of what was written."""
    per_key = written.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.count_if(F.col("_n") > 1).alias("duplicate_ids"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("surplus_rows")
    )


def checked_write(
    df: DataFrame, root: str, key: str, rules: Mapping[str, Column], more: Mapping[str, Column] | None = None
) -> tuple[str, dict[str, Any]]:
    """Stage ``df`` and check it on the way: the path, and the counts of ``quality_checks`` with
    ``all_passed``, beside the metrics ``more``. Only the key column is read back, to find keys
    that repeat."""
    path, seen = staged(df, root, {**check_metrics(key, rules), **(more or {})})
    spark = df.sparkSession
    seen |= repeated_keys(spark.read.schema(df.schema).parquet(path), key).first().asDict()
    failing = ["null_ids", *rules, "duplicate_ids"]
    return path, seen | {"all_passed": all(seen[name] == 0 for name in failing)}
