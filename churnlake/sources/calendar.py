"""Month calendar generated inside Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dim_date(span: DataFrame) -> DataFrame:
    """One row per month from ``first`` to ``last`` of a one-row frame of dates."""
    months = span.select(
        F.explode(
            F.sequence(F.trunc("first", "month"), F.trunc("last", "month"), F.expr("interval 1 month"))
        ).alias("m")
    )
    return months.select(
        (F.year("m") * 100 + F.month("m")).alias("date_key"),
        F.year("m").alias("year"),
        F.quarter("m").alias("quarter"),
        F.month("m").alias("month"),
        F.date_format("m", "MMM").alias("month_name"),
        F.lit(1).alias("is_weekday"),
    )


def dim_date_years(spark: SparkSession, first_year: int = 2023, last_year: int = 2025) -> DataFrame:
    """The calendar of whole years."""
    span = spark.range(1).select(
        F.make_date(F.lit(first_year), F.lit(1), F.lit(1)).alias("first"),
        F.make_date(F.lit(last_year), F.lit(12), F.lit(1)).alias("last"),
    )
    return dim_date(span)
