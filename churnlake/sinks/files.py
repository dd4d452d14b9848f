"""File outputs.

A full table is written in parallel. One file is for results that the caller bounds, such as
an aggregate or a limited list.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_single_file(df: DataFrame, path: str) -> None:
    """One CSV file, whatever the size: for a result that the caller bounds; a table of open
    size belongs in ``write_csv``. Only the finished rows go to one task, not the work
    before."""
    write_csv(df.repartition(1), path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], sort: Sequence[str] = ()) -> None:
    """Folder per value. Rebalancing gathers a value's rows without forcing a hot value
    into one task: adaptive execution splits a large partition and joins small ones."""
    out = df.hint("rebalance", *by)
    if sort:
        out = out.sortWithinPartitions(*by, *sort)
    out.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_partitioned_csv(df: DataFrame, path: str, by: Sequence[str]) -> None:
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).option("header", True).csv(path)


def layout_for_filters(df: DataFrame, path: str, by: str, sort: Sequence[str]) -> None:
    """Layout in place of indexes: folders for the coarse filter column, and rows sorted on
    the others so that row groups can be skipped by their minimum and maximum."""
    write_partitioned(df, path, [by], sort)


def write_json_report(report: DataFrame, path: str) -> None:
    """A one-row report as one JSON document."""
    report.repartition(1).write.mode("overwrite").json(path)


def ctas(df: DataFrame, name: str, path: str) -> DataFrame:
    """CREATE OR REPLACE TABLE AS SELECT, kept as Parquet under ``path``."""
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


@contextmanager
def reused(df: DataFrame) -> Iterator[DataFrame]:
    """Frame kept in memory (spilling to disk) while several actions read it."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def split_outputs(enriched: DataFrame) -> Mapping[str, DataFrame]:
    """All rows, the risky retained ones, and the intervention list."""
    retained = F.col("churn") == 0
    targets = enriched.filter(retained & (F.col("risk_score") >= 7)).select(
        "customer_id", "contract", "monthly_charges", "tenure", "risk_score", "risk_label", "lifetime_value"
    )
    return {
        "enriched": enriched,
        "high_risk": enriched.filter(F.col("risk_label").isin("Critical", "High") & retained),
        "intervention": targets.orderBy(F.desc("monthly_charges"), "customer_id"),
    }


def write_split_outputs(enriched: DataFrame, root: str) -> list[str]:
    """Write the three subsets of one frame. The frame is computed for the first and read back
    for the others."""
    enriched.write.mode("overwrite").parquet(f"{root}/enriched")
    outputs = split_outputs(enriched.sparkSession.read.schema(enriched.schema).parquet(f"{root}/enriched"))
    for name, df in outputs.items():
        if name != "enriched":
            df.write.mode("overwrite").parquet(f"{root}/{name}")
    return list(outputs)


def audit_columns(df: DataFrame, run_date: str, author: str, version: str, source: str) -> DataFrame:
    """Lineage stamped on every row; the time is an argument, so a rerun gives the same rows."""
    stamps = {"run_date": run_date, "run_by": author, "pipeline_version": version, "data_source": source}
    return df.withColumns({name: F.lit(value) for name, value in stamps.items()})


def repartition_coalesce(df: DataFrame, up: int, down: int) -> Mapping[str, DataFrame]:
    """The frame spread over ``up`` partitions, and that merged to ``down`` without a shuffle."""
    spread = df.repartition(up)
    return {"spread": spread, "merged": spread.coalesce(down)}
