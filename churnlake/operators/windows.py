"""Rankings, running figures and comparisons with a group.

Row-level global rankings and running sums over any key go through ``plans.ordering``. A
window without ``partitionBy`` appears below only over aggregates whose row count is fixed
by their domain: lifecycle stages, or months of tenure up to a limit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.functions.ladders import map_values
from churnlake.functions.numbers import (
    as_double,
    churn_rate,
    churned_count,
    mean,
    money,
    percent,
    percent_of_money,
    raw_mean,
    total,
    total_where,
)
from churnlake.operators.relational import Order, sort_keys
from churnlake.plans.bounded import freeze
from churnlake.plans.digits import tile_of
from churnlake.plans.ordering import ranked, running_sum

# Names of charge quartiles and value quintiles.
QUARTILE_TIERS = {1: "Budget", 2: "Standard", 3: "Premium", 4: "Enterprise"}
CLV_TIERS = {1: "Bronze", 2: "Silver", 3: "Gold", 4: "Platinum", 5: "Diamond"}


def row_number_global(df: DataFrame, by: Order, tie: Sequence[str], name: str = "rank_overall") -> DataFrame:
    return ranked(df, by, tie, row_number=name)


def top_n_per_group(df: DataFrame, group: str, by: Order, n: int, name: str) -> DataFrame:
    """First ``n`` rows per group. The rank filter lets Spark drop all but ``n`` rows per
    group in each task before the shuffle, so a hot group stays small."""
    w = Window.partitionBy(group).orderBy(*sort_keys(by))
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def rank_vs_dense(df: DataFrame, by: Order, tie: Sequence[str]) -> DataFrame:
    """Both rankings over all rows."""
    return ranked(df, by, tie, rank="rank_with_gaps", dense_rank="dense_rank_no_gaps")


def rank_top_with_ties(df: DataFrame, group: str, by: Order, n: int, name: str) -> DataFrame:
    """Rows ranked at most ``n`` in their group, every tied row kept."""
    return _with_value_ranks(df, group, by, n, {name: "_rank"})


def _with_value_ranks(df: DataFrame, group: str, by: Order, n: int, names: Mapping[str, str]) -> DataFrame:
    """Rows whose values rank at most ``n`` in their group.

    The distinct values are counted and ranked, at most ``n`` of them per group, and joined
    back: no task sorts the rows of a group, however many share a value.
    """
    columns = [c for c, _ in by]
    order = Window.partitionBy(group).orderBy(*sort_keys(by))
    before = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    values = (
        df.groupBy(group, *columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_dense", F.row_number().over(order))
        .filter(F.col("_dense") <= n)
        .withColumn("_rank", (F.coalesce(before, F.lit(0)) + 1).cast("int"))
        .filter(F.col("_rank") <= n)
    )
    told = values.select(
        *[F.col(c).alias(f"_v_{c}") for c in (group, *columns)], *[F.col(c).alias(name) for name, c in names.items()]
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_v_{c}")) for c in (group, *columns)])
    return df.join(told, same).select(*df.columns, *names)


def rank_and_dense_top(df: DataFrame, group: str, by: Order, n: int) -> DataFrame:
    """The same with both rankings beside each row."""
    return _with_value_ranks(df, group, by, n, {"spend_rank": "_rank", "spend_dense_rank": "_dense"})


def rank_then_filter(df: DataFrame, group: str, by: Order, n: int, keep: Column, name: str) -> DataFrame:
    """Rank over all rows of the group, then keep the chosen ones among the first ``n``;
    fewer than ``n`` may remain."""
    return rank_top_with_ties(df, group, by, n, name).filter(keep)


def running_total(df: DataFrame, key: str) -> DataFrame:
    """Revenue per key, largest first, with running total and share of the whole."""
    per_key = df.groupBy(key).agg(
        F.sum(money("monthly_charges")).cast("decimal(28,2)").alias("_rev"), F.count(F.lit(1)).alias("customers")
    )
    everything = df.agg(F.sum(money("monthly_charges"))).scalar()
    return running_sum(per_key, "_rev", "desc", "_rev", "_running").select(
        key,
        "customers",
        as_double("_rev").alias("monthly_rev"),
        as_double("_running").alias("running_total"),
        percent_of_money(F.col("_rev"), everything).alias("pct_of_total"),
    )


def share_of_total(df: DataFrame, key: str, value: str) -> DataFrame:
    """Each key's part of the total; the total is one scalar, not a window."""
    per_key = df.groupBy(key).agg(F.sum(money(value)).cast("decimal(28,2)").alias("_v"))
    everything = df.agg(F.sum(money(value))).scalar()
    return per_key.select(
        key, as_double("_v").alias("value"), percent_of_money(F.col("_v"), everything).alias("pct_of_total")
    )


def with_group_mean(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Unrounded group mean on every row.

    A window would send a whole group to one task. The means are aggregated with partial
    sums and joined back.
    """
    means = df.groupBy(group).agg(raw_mean(value).alias(name))
    same = F.col(group).eqNullSafe(F.col("_group"))
    return df.join(means.withColumnRenamed(group, "_group"), same, "left").drop("_group")


def vs_partition_avg(df: DataFrame) -> DataFrame:
    """Churned rows above their contract's mean, with the distance from it."""
    with_mean = with_group_mean(df, "contract", "monthly_charges", "_mean")
    overall = df.agg(raw_mean("monthly_charges")).scalar()
    rows = with_mean.withColumn("_avg", F.round("_mean", 2)).filter(
        (F.col("monthly_charges") > F.col("_avg")) & (F.col("churn") == 1)
    )
    return rows.select(
        "customer_id",
        "contract",
        as_double("monthly_charges").alias("monthly_charges"),
        as_double("_avg").alias("avg_in_contract"),
        F.round(overall, 2).cast("double").alias("overall_avg"),
        as_double(F.col("monthly_charges") - F.col("_avg")).alias("vs_contract_avg"),
        "churn",
    )


def ntile_quartiles(df: DataFrame, key: str) -> DataFrame:
    """Charge quartiles over all rows and the churn of each. ``key`` is a whole number that
    identifies a row; charges have two decimals."""
    cents = (money("monthly_charges") * 100).cast("bigint")
    rows = freeze(df.select(F.col(key).cast("bigint").alias("_key"), "monthly_charges", "churn", cents.alias("_cents")), "charges")
    tiles = rows.withColumn("charge_quartile", tile_of(rows, "_cents", "_key", 4))
    return tiles.groupBy("charge_quartile").agg(
        F.count(F.lit(1)).alias("customers"),
        as_double(F.min("monthly_charges")).alias("min_charge"),
        as_double(F.max("monthly_charges")).alias("max_charge"),
        mean("monthly_charges").alias("avg_charge"),
        churned_count().alias("churned"),
        churn_rate().alias("churn_rate_pct"),
    )


def clv_tiers(df: DataFrame, key: str) -> DataFrame:
    """Value quintiles; the amount at risk is the monthly charge of the churned. ``key`` is a
    whole number that identifies a row."""
    clv = money("monthly_charges") * F.col("tenure")
    valued = df.select(F.col(key).cast("bigint").alias("_key"), "monthly_charges", "churn", clv.alias("_clv"))
    rows = freeze(valued.withColumn("_cents", (F.col("_clv") * 100).cast("bigint")), "values")
    tiles = rows.withColumn("clv_quintile", tile_of(rows, "_cents", "_key", 5))
    return (
        tiles.groupBy("clv_quintile")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            as_double(F.min("_clv")).alias("min_clv"),
            as_double(F.max("_clv")).alias("max_clv"),
            mean("_clv").alias("avg_clv"),
            churned_count().alias("churned"),
            churn_rate().alias("churn_rate_pct"),
            total_where(F.col("churn") == 1, "monthly_charges").alias("clv_at_risk"),
        )
        .withColumn("tier", map_values(F.col("clv_quintile"), CLV_TIERS))
    )


def cumulative_rate(df: DataFrame, max_tenure: int) -> DataFrame:
    """Churn by month of tenure with cumulative figures; the limit applies before the window."""
    months = (
        df.filter(F.col("tenure") <= max_tenure)
        .groupBy("tenure")
        .agg(F.count(F.lit(1)).alias("customers"), churned_count().alias("churned"))
    )
    # One row per month up to max_tenure.
    w = Window.orderBy("tenure").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    seen, gone = F.sum("customers").over(w), F.sum("churned").over(w)
    return months.select(
        "tenure",
        "customers",
        "churned",
        percent(F.col("churned"), F.col("customers")).alias("churn_rate_pct"),
        seen.alias("cumulative_customers"),
        gone.alias("cumulative_churned"),
        percent(gone, seen).alias("cumulative_churn_rate"),
    )


def moving_average(df: DataFrame, max_tenure: int, rows: int = 3) -> DataFrame:
    """Churn by month of tenure with a trailing mean of the rounded monthly rates."""
    months = (
        df.filter(F.col("tenure") <= max_tenure)
        .groupBy("tenure")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            churned_count().alias("churned"),
            F.round(churned_count().cast("decimal(20,0)") * 100 / F.count(F.lit(1)).cast("decimal(20,0)"), 1)
            .cast("decimal(10,1)")
            .alias("_rate"),
            mean("monthly_charges").alias("avg_charge"),
        )
    )
    ordered = Window.orderBy("tenure")
    trailing = ordered.rowsBetween(-(rows - 1), Window.currentRow)
    last = F.sum("_rate").over(trailing) / F.count("_rate").over(trailing).cast("decimal(10,0)")
    return months.select(
        "tenure",
        "customers",
        "churned",
        as_double("_rate").alias("churn_rate"),
        "avg_charge",
        F.sum("customers")
        .over(ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("cumulative_customers"),
        F.round(last, 1).cast("double").alias("moving_avg_churn"),
    )


def ranked_customers(df: DataFrame, key: str) -> DataFrame:
    """Revenue rank, charge quartile, distance from the contract mean and tier of each row.

    The rank runs down and the quartile up, so both come from one ascending order: with
    ``n`` rows, a value tied at positions ``a..b`` from the bottom ranks ``n - b + 1``
    from the top.
    """
    placed = ranked(
        df,
        [("monthly_charges", "asc")],
        [key],
        row_number="_row",
        ntile={"charge_quartile": 4},
    )
    ties = placed.groupBy("monthly_charges").agg(F.max("_row").alias("_last"), F.count(F.lit(1)).alias("_ties"))
    tied = ties.filter("_ties > 1").select("monthly_charges", "_last")
    n = df.agg(F.count(F.lit(1))).scalar()
    out = placed.join(tied, "monthly_charges", "left").withColumn(
        "revenue_rank", n - F.coalesce("_last", "_row") + 1
    )
    out = with_group_mean(out.drop("_row", "_last"), "contract", "monthly_charges", "_mean")
    return out.withColumns(
        {
            "contract_avg_charge": F.round("_mean", 2).cast("double"),
            "vs_contract_avg": F.round(money("monthly_charges") - F.col("_mean"), 2).cast("double"),
            "customer_tier": map_values(F.col("charge_quartile"), QUARTILE_TIERS),
        }
    ).drop("_mean")


def tier_summary(ranked_rows: DataFrame) -> DataFrame:
    return ranked_rows.groupBy("customer_tier").agg(
        F.count(F.lit(1)).alias("customers"),
        churned_count().alias("churned"),
        mean("monthly_charges").alias("avg_charge"),
        churn_rate().alias("churn_rate_pct"),
    )


def lifecycle_report(df: DataFrame, stage: Column) -> DataFrame:
    """Per stage: churn, revenue, the share of it at risk, and customers up to the stage."""
    gone = F.col("churn") == 1
    at_risk = F.sum(F.when(gone, money("monthly_charges")).otherwise(F.lit(0).cast("decimal(18,2)")))
    stages = (
        df.withColumn("stage", stage)
        .groupBy("stage")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            churned_count().alias("churned"),
            churn_rate().alias("churn_pct"),
            total("monthly_charges").alias("total_revenue"),
            as_double(at_risk).alias("revenue_at_risk"),
            percent_of_money(at_risk, F.sum(money("monthly_charges"))).alias("risk_pct"),
        )
    )
    # One row per lifecycle stage.
    w = Window.orderBy("stage").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return stages.withColumn("cumulative_customers", F.sum("customers").over(w))


def latest_per_key(df: DataFrame, key: str, when: Sequence[str], *values: str) -> DataFrame:
    """Values of the newest row per key, with partial aggregation instead of a sort."""
    newest = F.max_by(F.struct(*values), F.struct(*when))
    return df.groupBy(key).agg(newest.alias("_v")).select(key, "_v.*")
