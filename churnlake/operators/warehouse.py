"""Insert, update, upsert and delete patterns, the star schema and the reporting views.

Frames are immutable: a statement returns the changed frame and nothing is visible to
readers until it is published (``sinks.versions``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions.numbers import churn_rate, churned_count, mean, raw_mean, total, total_where
from churnlake.functions.scoring import (
    action_864,
    action_scored,
    churn_probability,
    lifecycle_4,
    lifetime_value,
    risk_level_view,
    risk_score_full,
)
from churnlake.operators.aggregates import executive_kpis, measures
from churnlake.operators.joins import anti_join
from churnlake.plans.ordering import number_rows


def staging_insert(df: DataFrame, staged_at: str) -> DataFrame:
    """Rows as they arrive, stamped and not yet processed."""
    return df.withColumns({"staged_at": F.lit(staged_at), "is_processed": F.lit(0)})


def insert_new_only(target: DataFrame, staging: DataFrame, key: str, valid: Column) -> DataFrame:
    """Target plus the unprocessed, valid staged rows whose key it does not hold.

    The key test is ``NOT IN``: a null key is never inserted.
    """
    fresh = staging.filter((F.col("is_processed") == 0) & valid)
    new = anti_join(fresh, target.select(key), key, key)
    return target.unionByName(new.select(*target.columns))


def mark_processed(staging: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Flag set on the staged rows that are in the target by now."""
    loaded = target.select(F.col(key).alias("_loaded")).distinct()
    marked = staging.join(loaded, F.col(key) == F.col("_loaded"), "left")
    flag = F.when(F.col("_loaded").isNotNull(), 1).otherwise(F.col("is_processed"))
    return marked.withColumn("is_processed", flag).drop("_loaded")


def update_where(df: DataFrame, where: Column, changes: Mapping[str, Column]) -> DataFrame:
    """New values where the predicate is true; every expression sees the old row."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {c: F.when(where, new.cast(types[c])).otherwise(F.col(c)) for c, new in changes.items()}
    )


def upsert_by_key(target: DataFrame, updates: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Insert or replace by key; of several updates to one key the last in ``order`` wins."""
    rest = [c for c in target.columns if c != key]
    last = updates.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(key, "_row.*")
    kept = target.join(last.select(key), key, "left_anti")
    return kept.unionByName(last.select(*target.columns))


def delete_where(df: DataFrame, where: Column) -> DataFrame:
    """Rows for which the predicate is not true; null keeps the row."""
    return df.filter(~F.coalesce(where, F.lit(False)))


def dry_run_update(df: DataFrame, where: Column, changes: Mapping[str, Column], watch: Column, value: str) -> DataFrame:
    """Effect of an update without applying it: rows touched, and a mean before and after."""
    changed = update_where(df.withColumns({"_before": F.col(value), "_hit": where}), where, changes)
    before, after = (
        F.round(raw_mean(F.when(watch, F.col(c))), 2).cast("double") for c in ("_before", value)
    )
    return changed.agg(
        F.count_if("_hit").alias("updated"), after.alias("new_avg"), before.alias("orig_avg")
    )


def initial_scores(df: DataFrame) -> DataFrame:
    """Score table of retained customers."""
    return df.filter(F.col("churn") == 0).select(
        "customer_id",
        risk_score_full().alias("risk_score"),
        churn_probability().alias("churn_probability"),
        action_scored().alias("recommended_action"),
    )


def refreshed_scores(scores: DataFrame, min_score: int = 6) -> DataFrame:
    """Higher scores for the risky part of the table, as updates for ``upsert_by_key``."""
    raised = F.round(F.col("churn_probability").cast("decimal(5,3)") * F.lit("1.1").cast("decimal(2,1)"), 3)
    action = F.when(F.col("risk_score") >= 7, "URGENT — call today").otherwise(F.col("recommended_action"))
    return scores.filter(F.col("risk_score") >= min_score).select(
        "customer_id",
        (F.col("risk_score") + 1).alias("risk_score"),
        raised.cast("double").alias("churn_probability"),
        action.alias("recommended_action"),
    )


def dim_build(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Distinct rows of the columns with a dense surrogate key in their order.

    The keys come from the distributed ordering, so a dimension as large as the fact
    table does not pass through one task.
    """
    rows = df.select(*columns).distinct()
    by = [(c, "asc") for c in columns]
    return number_rows(rows, by, [], key).select(key, *columns)


def dim_insert_ignore(df: DataFrame, unique: Sequence[str], others: Sequence[str], key: str) -> DataFrame:
    """One row per unique combination; of several the smallest remaining values are kept."""
    kept = df.groupBy(*unique).agg(F.min(F.struct(*others)).alias("_o")).select(*unique, "_o.*")
    return number_rows(kept, [(c, "asc") for c in unique], [], key).select(key, *unique, *others)


def dim_load(dim: DataFrame, df: DataFrame, unique: Sequence[str], others: Sequence[str], key: str) -> DataFrame:
    """Insert or ignore into a dimension that already has rows.

    Rows of ``dim`` keep their surrogate keys and values whatever comes in, so facts that
    point at them stay right. Combinations that ``dim`` does not have are numbered from its
    largest key on, in their order; a null counts as a value like any other. Of several
    incoming rows the smallest remaining values are kept. Only the new combinations are
    ordered, not the dimension.
    """
    incoming = df.groupBy(*unique).agg(F.min(F.struct(*others)).alias("_o")).select(*unique, "_o.*")
    known = dim.select(*[F.col(c).alias(f"_known_{c}") for c in unique])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in unique])
    fresh = incoming.join(known, same, "left_anti")
    last = F.coalesce(dim.agg(F.max(key)).scalar(), F.lit(0))
    numbered = number_rows(fresh, [(c, "asc") for c in unique], [], "_nth")
    new = numbered.select((F.col("_nth") + last).cast(dim.schema[key].dataType).alias(key), *unique, *others)
    return dim.select(key, *unique, *others).unionByName(new)


def store_by_key(df: DataFrame, path: str, key: str) -> None:
    """A fact in one folder per value of a dimension's key, so that a query that picks some
    dimension rows reads only their folders. Rows of a hot value are split over several files."""
    df.hint("rebalance", key).write.partitionBy(key).parquet(path)


def fact_build(
    df: DataFrame,
    plans: DataFrame | None = None,
    payments: DataFrame | None = None,
    customers: DataFrame | None = None,
) -> DataFrame:
    """Measures with the surrogate key of each given dimension; an unknown natural key
    leaves a null.

    Adaptive execution picks each join's strategy by the dimension's size.
    """
    out, keys = df, []
    if plans is not None:
        natural = ["contract", "internet_service", "phone_service"]
        out = out.join(plans.select("plan_key", *natural), natural, "left")
        keys.append("plan_key")
    if payments is not None:
        out = out.join(payments.select("payment_key", "payment_method"), "payment_method", "left")
        keys.append("payment_key")
    if customers is not None:
        out = out.join(customers.select("customer_key", "customer_id"), "customer_id", "left")
        keys.append("customer_key")
    return out.select(
        *keys,
        "customer_id",
        "monthly_charges",
        "total_charges",
        F.col("tenure").alias("tenure_months"),
        F.col("churn").alias("is_churned"),
        risk_score_full().alias("churn_risk_score"),
        lifetime_value().alias("lifetime_value"),
    )


def _star(fact: DataFrame, dim: DataFrame, key: str, by: Sequence[str], *measures: Column) -> DataFrame:
    return (
        fact.join(dim, key)
        .groupBy(*by)
        .agg(*measures, churned_count("is_churned").alias("churned"), churn_rate("is_churned").alias("churn_rate"))
    )


def star_query_plan(fact: DataFrame, plans: DataFrame) -> DataFrame:
    return _star(
        fact,
        plans.select("plan_key", "contract", "internet_service"),
        "plan_key",
        ["contract", "internet_service"],
        F.count(F.lit(1)).alias("subscriptions"),
        mean("monthly_charges").alias("avg_monthly"),
        total("monthly_charges").alias("total_revenue"),
    )


def star_query_pruned(fact: DataFrame, plans: DataFrame, contract: str) -> DataFrame:
    """Revenue and churn of one contract's plans from a fact stored by ``plan_key``
    (``store_by_key``): the plans that are left tell at run time which folders are read."""
    some = plans.filter(F.col("contract") == contract).select("plan_key", "contract", "internet_service")
    return (
        fact.join(some, "plan_key")
        .groupBy("contract", "internet_service")
        .agg(F.count(F.lit(1)).alias("customers"), total("monthly_charges").alias("revenue"), churn_rate("is_churned").alias("churn_rate_pct"))
    )


def star_query_payment(fact: DataFrame, payments: DataFrame) -> DataFrame:
    """Per category and risk; a group with several reliabilities reports the lowest."""
    return _star(
        fact,
        payments.select("payment_key", "payment_category", "risk_level", "reliability_score"),
        "payment_key",
        ["payment_category", "risk_level"],
        F.min("reliability_score").alias("reliability_score"),
        F.count(F.lit(1)).alias("customers"),
        total("monthly_charges").alias("total_revenue"),
    )


def star_query_customer(fact: DataFrame, customers: DataFrame) -> DataFrame:
    return _star(
        fact,
        customers.select("customer_key", "tenure_group", "senior_citizen"),
        "customer_key",
        ["tenure_group", "senior_citizen"],
        F.count(F.lit(1)).alias("customers"),
        mean("lifetime_value").alias("avg_ltv"),
    )


def reporting_views(df: DataFrame) -> dict[str, DataFrame]:
    """The five reporting views; the intervention list is built on the risk view."""
    gone = F.col("churn") == 1
    risk = df.select(
        "customer_id",
        "contract",
        "internet_service",
        "payment_method",
        "monthly_charges",
        "tenure",
        "churn",
        risk_score_full().alias("risk_score"),
        risk_level_view().alias("risk_level"),
        lifetime_value().alias("lifetime_value"),
    )
    interventions = (
        risk.filter("churn = 0").withColumn("action", action_864(F.col("risk_score"))).drop("churn", "risk_level")
    )
    return {
        "vw_customer_risk": risk,
        "vw_churn_summary": df.groupBy("contract", "internet_service").agg(
            *measures("total", "churned", "churn_rate_pct", "avg_monthly", "total_revenue", "revenue_at_risk")
        ),
        "vw_revenue_dashboard": df.withColumn("lifecycle", lifecycle_4())
        .groupBy("lifecycle", "contract")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            total("monthly_charges").alias("monthly_revenue"),
            total_where(gone, "monthly_charges").alias("revenue_at_risk"),
            churn_rate().alias("churn_rate_pct"),
        ),
        "vw_intervention_list": interventions,
        "vw_executive_kpis": executive_kpis(df),
    }


def create_views(views: Mapping[str, DataFrame]) -> None:
    """Register the frames as temp views; a view on a view is inlined by the analyzer."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
