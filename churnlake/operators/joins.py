"""Joins with lookups, between aggregates and by membership.

The strategy is left to the optimizer, which broadcasts a side of known small size, such
as a literal lookup. A side whose size is only known once it is computed is judged by its
bytes at run time, by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions.numbers import as_double, churn_rate, churned_count, mean, total
from churnlake.functions.scoring import discounted_price, lookup_risk_label


def _on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[x] == right[y] for x, y in pairs])


def lookup_join(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, how: str = "inner") -> DataFrame:
    """Join a literal lookup on differently named keys and drop the lookup's key."""
    side = lookup.withColumnRenamed(lookup_key, "_key")
    return df.join(side, F.col(key) == F.col("_key"), how).drop("_key")


def inner_join_lookup(df: DataFrame, pricing: DataFrame) -> DataFrame:
    """Contract terms and the discounted price on every matching row."""
    terms = pricing.select("contract_type", "discount_pct", "risk_level")
    joined = lookup_join(df, terms, "contract", "contract_type")
    return joined.withColumn("discounted_price", as_double(discounted_price()))


def inner_join_aggregate(df: DataFrame, pricing: DataFrame) -> DataFrame:
    terms = pricing.select("contract_type", "discount_pct", "risk_level")
    joined = df.join(terms, F.col("contract") == F.col("contract_type"))
    price = F.col("monthly_charges") * (100 - F.col("discount_pct").cast("decimal(5,2)")) / 100
    exact = price.cast("decimal(30,4)")
    return joined.groupBy("contract_type").agg(
        F.min("risk_level").alias("risk_level"),
        F.count("customer_id").alias("customers"),
        churned_count().alias("churned"),
        churn_rate().alias("churn_rate_pct"),
        F.round(F.try_divide(F.sum(exact), F.count(exact).cast("decimal(20,0)")), 2)
        .cast("double")
        .alias("avg_discounted"),
    )


def left_join_lookup(df: DataFrame, sla: DataFrame) -> DataFrame:
    """Service level on every row, null where the service is unknown."""
    return lookup_join(
        df,
        sla.select("service_type", "speed_mbps", "support_tier", "monthly_cost"),
        "internet_service",
        "service_type",
        "left",
    ).withColumnRenamed("monthly_cost", "service_base_cost")


def left_join_aggregate(df: DataFrame, sla: DataFrame) -> DataFrame:
    """Churn per support tier; a tier with several speeds reports the lowest."""
    return (
        left_join_lookup(df, sla)
        .groupBy("support_tier")
        .agg(
            F.count("customer_id").alias("customers"),
            churned_count().alias("churned"),
            churn_rate().alias("churn_rate_pct"),
            mean("monthly_charges").alias("avg_monthly"),
            F.min("speed_mbps").alias("speed_mbps"),
        )
    )


def plan_join_aggregate(df: DataFrame, plans: DataFrame) -> DataFrame:
    """Churn and revenue per plan of a lookup that shares the key's name."""
    return (
        df.join(plans, "contract", "left")
        .groupBy(*plans.columns)
        .agg(
            F.count(F.lit(1)).alias("customers"),
            churned_count().alias("churned"),
            churn_rate().alias("churn_rate_pct"),
            total("monthly_charges").alias("total_revenue"),
        )
    )


def multi_join(df: DataFrame, pricing: DataFrame, sla: DataFrame, payment: DataFrame) -> DataFrame:
    """Inner join to the contract terms, left joins to service level and payment risk."""
    out = lookup_join(
        df,
        pricing.select(
            "contract_type", "discount_pct", F.col("risk_level").alias("contract_risk"), "retention_bonus"
        ),
        "contract",
        "contract_type",
    )
    out = lookup_join(
        out, sla.select("service_type", "speed_mbps", "support_tier"), "internet_service", "service_type", "left"
    )
    return lookup_join(
        out,
        payment.select(
            F.col("payment_method").alias("method"),
            F.col("risk_level").alias("payment_risk"),
            "reliability_score",
        ),
        "payment_method",
        "method",
        "left",
    )


def multi_join_enrich(df: DataFrame, pricing: DataFrame, sla: DataFrame, payment: DataFrame) -> DataFrame:
    """All lookups beside each row, with the discounted price and the overall risk."""
    return multi_join(df, pricing, sla, payment).withColumns(
        {
            "discounted_price": as_double(discounted_price()),
            "overall_risk": lookup_risk_label(F.col("contract_risk"), F.col("payment_risk")),
        }
    )


def multi_join_filter(
    df: DataFrame, pricing: DataFrame, sla: DataFrame, payment: DataFrame, risk: str = "High"
) -> DataFrame:
    """Churned rows whose contract and payment method both carry the given risk."""
    joined = multi_join(df.filter(F.col("churn") == 1), pricing, sla, payment)
    return joined.filter((F.col("contract_risk") == risk) & (F.col("payment_risk") == risk))


def risk_matrix_join(df: DataFrame, pricing: DataFrame, payment: DataFrame) -> DataFrame:
    out = lookup_join(
        df,
        pricing.select("contract_type", F.col("risk_level").alias("contract_risk")),
        "contract",
        "contract_type",
    )
    out = lookup_join(
        out,
        payment.select(F.col("payment_method").alias("method"), F.col("risk_level").alias("payment_risk")),
        "payment_method",
        "method",
        "left",
    )
    return out.groupBy("contract_risk", "payment_risk").agg(
        F.count(F.lit(1)).alias("customers"),
        churned_count().alias("churned"),
        churn_rate().alias("churn_rate_pct"),
    )


def join_multi_key(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "left") -> DataFrame:
    """Composite-key join; the optimizer sees every pair as one shuffle key."""
    return left.join(right, _on(left, right, pairs), how)


def join_cte_results(df: DataFrame) -> DataFrame:
    """Churned and retained profile side by side per contract.

    Both aggregates come from the same rows, so one pass with conditional aggregates
    gives what a join of two would; a contract without rows on one side is dropped as an
    inner join would drop it.
    """
    gone, here = F.col("churn") == 1, F.col("churn") == 0

    def profile(cond: Column, prefix: str) -> list[Column]:
        return [
            F.count_if(cond).alias(f"{prefix}_count"),
            mean(F.when(cond, F.col("monthly_charges"))).alias(f"{prefix}_avg_charge"),
            mean(F.when(cond, F.col("tenure")), 1).alias(f"{prefix}_avg_tenure"),
        ]

    both = df.groupBy("contract").agg(*profile(gone, "churned"), *profile(here, "retained"))
    return both.filter((F.col("churned_count") > 0) & (F.col("retained_count") > 0))


def broadcast_join(df: DataFrame, side: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join with a side that is expected to be small. It is broadcast if its bytes are below
    ``spark.sql.autoBroadcastJoinThreshold``, as planned or as measured at run time."""
    return df.join(side, key, how)


def semi_join(df: DataFrame, members: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return df.join(members, _on(df, members, pairs), "left_semi")


def anti_join(df: DataFrame, members: DataFrame, key: str, member_key: str) -> DataFrame:
    """NOT IN: nothing passes once a member is null, and a null key passes only an empty list.

    Nulls are rare, so they are decided by one scalar; the rows go through a plain
    anti-join that shuffles on the key.
    """
    facts = members.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(member_key).isNull()).alias("nulls")
    )
    total, nulls = facts.select("n").scalar(), facts.select("nulls").scalar()
    side = members.select(F.col(member_key).alias("_member")).filter("_member is not null")
    kept = df.join(side, F.col(key) == F.col("_member"), "left_anti")
    return kept.filter((total == 0) | ((nulls == 0) & F.col(key).isNotNull()))


def right_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return left.join(right, _on(left, right, pairs), "right")


def full_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return left.join(right, _on(left, right, pairs), "full")


def merge_reference_data(countries: DataFrame, latest: DataFrame, summary: DataFrame, key: str = "name") -> DataFrame:
    """Profile, newest measure and summary per name; unmatched names keep nulls."""
    return countries.join(latest, key, "left").join(summary, key, "left")


def attach_constants(df: DataFrame, source: DataFrame, picks: Mapping[str, str]) -> DataFrame:
    """Values of one looked-up row on every row, as scalar subqueries.

    ``source`` must hold one row; more than one is an error, none gives null.
    """
    return df.withColumns({name: source.select(column).scalar() for name, column in picks.items()})
