"""Projection, predicates, sorting, subqueries and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.functions.numbers import churn_rate, mean, money, raw_mean, total
from churnlake.functions.text import contains_ignoring_case

Order = Sequence[tuple[str, str]]


def sort_keys(by: Order) -> list[Column]:
    """Sort columns from (name, way) pairs; nulls always last so engines agree."""
    return [F.col(c).desc_nulls_last() if way == "desc" else F.col(c).asc_nulls_last() for c, way in by]


def select_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns)


def computed_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.withColumn(name, value)


def filter_eq(df: DataFrame, column: str, value: Any) -> DataFrame:
    return df.filter(F.col(column) == value)


def filter_all(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows that satisfy every condition; no condition keeps all rows."""
    return df.filter(reduce(lambda a, b: a & b, conditions)) if conditions else df


def filter_between(df: DataFrame, column: str, low: Any, high: Any) -> DataFrame:
    return df.filter(F.col(column).between(low, high))


def filter_in_list(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    return df.filter(F.col(column).isin(*values))


def filter_like(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """LIKE that ignores case."""
    return df.filter(F.col(column).ilike(pattern))


def contains_flag(df: DataFrame, column: str, needle: str, name: str) -> DataFrame:
    return df.withColumn(name, contains_ignoring_case(column, needle))


def select_distinct(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def parameterised_query(spark: SparkSession, sql: str, params: Mapping[str, Any], **views: DataFrame) -> DataFrame:
    """SQL text with ``:name`` parameters and ``{view}`` frames; values are never pasted in."""
    return spark.sql(sql, args=dict(params), **views)


def risk_report(
    interventions: DataFrame,
    min_monthly: float = 50,
    min_risk_score: int | None = None,
    limit: int = 10,
) -> DataFrame:
    """Retained customers above a charge and, when given, a risk score; riskiest first."""
    conditions = [F.col("monthly_charges") >= min_monthly]
    if min_risk_score:
        conditions.append(F.col("risk_score") >= min_risk_score)
    chosen = filter_all(interventions, *conditions).select(
        "customer_id", "contract", "internet_service", "monthly_charges", "risk_score", "action"
    )
    return order_limit(
        chosen, [("risk_score", "desc"), ("monthly_charges", "desc"), ("customer_id", "asc")], limit
    )


def segment_performance(df: DataFrame, contract: str | None = None, internet: str | None = None) -> DataFrame:
    """Churn and revenue per segment, optionally of one contract or service."""
    wanted = {"contract": contract, "internet_service": internet}
    chosen = filter_all(df, *[F.col(c) == v for c, v in wanted.items() if v])
    return (
        chosen.groupBy("contract", "internet_service")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            churn_rate().alias("churn_rate"),
            mean("monthly_charges").alias("avg_monthly"),
            total("monthly_charges").alias("total_revenue"),
        )
        .orderBy(*sort_keys([("churn_rate", "desc"), ("contract", "asc"), ("internet_service", "asc")]))
    )


def order_limit(df: DataFrame, by: Order, n: int) -> DataFrame:
    """Top ``n``; each task keeps ``n`` rows and the driver merges them. End ``by`` with a key."""
    return df.orderBy(*sort_keys(by)).limit(n)


def order_multi_key(df: DataFrame, by: Order) -> DataFrame:
    return df.orderBy(*sort_keys(by))


def limit_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """First ``n`` rows in key order, so that the answer is repeatable."""
    return order_limit(df, [(key, "asc")], n)


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows in the order of a seeded hash of the key: the same rows on any cluster."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)


def scalar_subquery_select(df: DataFrame, value: str, digits: int = 2) -> DataFrame:
    """Each row beside the mean of all rows."""
    overall = df.agg(raw_mean(value)).scalar()
    return df.withColumns(
        {
            "avg_charge": F.round(overall, digits).cast("double"),
            "diff_from_avg": F.round(money(value) - overall, digits).cast("double"),
        }
    )


def above_mean(df: DataFrame, value: str, population: DataFrame | None = None) -> DataFrame:
    """Rows above the mean of ``population`` (of all rows when not given)."""
    source = df if population is None else population
    return df.filter(money(value) > source.agg(raw_mean(value)).scalar())


def derived_table_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def cte_chain(df: DataFrame, min_charge: float, n: int) -> DataFrame:
    """High payers, then the retained flexible ones among them, dearest first."""
    high_value = df.filter(F.col("monthly_charges") > min_charge)
    at_risk = high_value.filter((F.col("contract") == "Month-to-month") & (F.col("churn") == 0))
    chosen = at_risk.select("customer_id", "contract", "monthly_charges", "tenure")
    return order_limit(chosen, [("monthly_charges", "desc"), ("customer_id", "asc")], n)


def union_all_segments(df: DataFrame, parts: Mapping[str, Column], name: str = "segment") -> DataFrame:
    """UNION ALL of labelled selections from one frame, in one scan.

    Each row is emitted once for every selection it belongs to, so a row in two of them
    appears twice, as it would in the union.
    """
    labels = F.array_compact(F.array(*[F.when(cond, label) for label, cond in parts.items()]))
    return df.select(F.explode(labels).alias(name), "*")


def union_all_count(df: DataFrame, parts: Sequence[Column], name: str) -> DataFrame:
    """Row count of the same stack; a row in two parts counts twice."""
    return df.agg(reduce(lambda a, b: a + b, [F.count_if(cond) for cond in parts]).alias(name))


def stack_frames(parts: Mapping[str, DataFrame], name: str = "segment") -> DataFrame:
    """UNION ALL of different frames by column name, each labelled."""
    labelled = [df.select(F.lit(label).alias(name), "*") for label, df in parts.items()]
    return reduce(DataFrame.unionByName, labelled)


def concat_frames(df: DataFrame, flag: str, yes: str, no: str, name: str = "segment") -> DataFrame:
    """Split by a 0/1 flag, tag the halves and stack them; a null flag belongs to neither."""
    return union_all_segments(df, {yes: F.col(flag) == 1, no: F.col(flag) == 0}, name)
