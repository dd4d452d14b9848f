"""Grouped and global measures of the churn table.

Every report is one grouped aggregate with map-side partial sums, so a group that holds a
third of all rows costs one partial row per task, not a task of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions.ladders import bin_right_closed, first_match
from churnlake.functions.numbers import (
    as_double,
    churn_rate,
    churned_count,
    mean,
    mean_where,
    money,
    percent,
    percent_of_money,
    total,
    total_where,
)
from churnlake.functions.scoring import YEAR_EDGES, YEAR_LABELS, segment_risk_label
from churnlake.operators.relational import sort_keys
from churnlake.plans.digits import quantiles

def measures(*names: str, count_as: str = "total") -> list[Column]:
    """Aggregates by report name."""
    known: Mapping[str, Callable[[], Column]] = {
        count_as: lambda: F.count(F.lit(1)),
        "churned": churned_count,
        "retained": lambda: F.count_if(F.col("churn") == 0),
        "churn_rate_pct": churn_rate,
        "avg_monthly": lambda: mean("monthly_charges"),
        "avg_tenure": lambda: mean("tenure", 1),
        "total_revenue": lambda: total("monthly_charges"),
        "revenue_at_risk": lambda: total_where(F.col("churn") == 1, "monthly_charges"),
    }
    return [known[n]().alias(n) for n in names]


def churn_by(df: DataFrame, keys: Sequence[str], names: Sequence[str], count_as: str = "total") -> DataFrame:
    """Named measures per group, worst churn first when the rate is among them."""
    out = df.groupBy(*keys).agg(*measures(*names, count_as=count_as))
    order = [("churn_rate_pct", "desc")] if "churn_rate_pct" in names else []
    return out.orderBy(*sort_keys([*order, *[(k, "asc") for k in keys]]))


def global_kpis(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_customers"),
        churned_count().alias("total_churned"),
        mean("monthly_charges").alias("avg_monthly_charge"),
        mean("tenure", 1).alias("avg_tenure_months"),
        as_double(F.min("monthly_charges")).alias("min_charge"),
        as_double(F.max("monthly_charges")).alias("max_charge"),
        total("monthly_charges").alias("total_monthly_revenue"),
    )


def executive_summary(df: DataFrame) -> DataFrame:
    """Headline figures in one pass, split by churned and retained where it matters."""
    gone, kept = F.col("churn") == 1, F.col("churn") == 0
    return df.agg(
        F.count(F.lit(1)).alias("total_customers"),
        churned_count().alias("total_churned"),
        churn_rate(digits=2).alias("churn_rate_pct"),
        mean("monthly_charges").alias("avg_monthly_charge"),
        total("monthly_charges").alias("total_monthly_revenue"),
        total(F.col("monthly_charges") * 12).alias("annual_revenue"),
        total_where(gone, "monthly_charges").alias("revenue_at_risk"),
        mean("tenure", 1).alias("avg_tenure_months"),
        mean_where(kept, "tenure", 1).alias("avg_retained_tenure"),
        mean_where(gone, "tenure", 1).alias("avg_churned_tenure"),
    )


def executive_kpis(df: DataFrame) -> DataFrame:
    """The dashboard version, with the mean lifetime value of retained customers."""
    gone, kept = F.col("churn") == 1, F.col("churn") == 0
    return df.agg(
        F.count(F.lit(1)).alias("total_customers"),
        churned_count().alias("total_churned"),
        churn_rate(digits=2).alias("churn_rate_pct"),
        total("monthly_charges").alias("monthly_revenue"),
        total_where(gone, "monthly_charges").alias("revenue_at_risk"),
        mean("monthly_charges").alias("avg_monthly_charge"),
        mean("tenure", 1).alias("avg_tenure_months"),
        mean_where(kept, F.col("monthly_charges") * F.col("tenure"), 2).alias("avg_retained_clv"),
    )


def in_band_order(df: DataFrame, band: str, labels: Sequence[str]) -> DataFrame:
    """Rows in the fixed order of their band labels."""
    place = first_match([(F.col(band) == label, i) for i, label in enumerate(labels)], len(labels))
    return df.orderBy(place)


def segment_having(df: DataFrame, keys: Sequence[str], min_rate: float) -> DataFrame:
    """Groups whose rounded churn rate exceeds ``min_rate``."""
    return churn_by(df, keys, ["total", "churn_rate_pct"]).filter(F.col("churn_rate_pct") > min_rate)


def segment_risk_matrix(df: DataFrame) -> DataFrame:
    """Contract by service with the risk label of the segment's churn rate."""
    names = ["customers", "churned", "churn_rate_pct", "total_revenue", "revenue_at_risk"]
    out = churn_by(df, ["contract", "internet_service"], names, count_as="customers")
    return out.withColumn("risk_label", segment_risk_label(F.col("churn_rate_pct")))


def churned_vs_retained(df: DataFrame) -> DataFrame:
    """The two sides of the churn flag; anything but 1 counts as retained in the label."""
    return (
        df.groupBy("churn")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            total("monthly_charges").alias("monthly_revenue"),
            mean("monthly_charges").alias("avg_monthly"),
            total("total_charges").alias("lifetime_revenue"),
        )
        .orderBy(F.desc("churn"))
        .select(F.when(F.col("churn") == 1, "Churned").otherwise("Retained").alias("status"), "*")
        .drop("churn")
    )


def group_by_expression(df: DataFrame, name: str, value: Column, names: Sequence[str]) -> DataFrame:
    """Measures per value of an expression."""
    return df.withColumn(name, value).groupBy(name).agg(*measures(*names, count_as="customers")).orderBy(name)


def conditional_count(df: DataFrame, key: str) -> DataFrame:
    """Both polarities of the flag per group; a null flag is in neither."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("churn") == 1).alias("churned"),
        F.count_if(F.col("churn") == 0).alias("retained"),
    )


def stddev_min_max(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("total"),
        mean(value).alias("avg_value"),
        as_double(F.max(value)).alias("max_value"),
        as_double(F.min(value)).alias("min_value"),
        F.round(F.stddev(as_double(value)), 2).alias("stddev_value"),
    )


def pivot_counts(df: DataFrame, row: str, column: str, names: Mapping[str, str]) -> DataFrame:
    """Rows per value of ``column``, one output column each, plus the row total."""
    cells = [F.count_if(F.col(column) == v).alias(name) for v, name in names.items()]
    return df.groupBy(row).agg(*cells, F.count(F.lit(1)).alias("total")).orderBy(F.desc("total"), row)


def pivot_rates(df: DataFrame, row: str, column: str, names: Mapping[str, str]) -> DataFrame:
    """Churn rate per value of ``column``; null where the cell has no rows."""
    cells = [
        percent(
            F.count_if((F.col(column) == v) & (F.col("churn") == 1)), F.count_if(F.col(column) == v)
        ).alias(name)
        for v, name in names.items()
    ]
    return df.groupBy(row).agg(*cells)


def pivot_value(df: DataFrame, row: str, column: str, value: str, names: Mapping[str, str], fill: float = 0) -> DataFrame:
    """Matrix of an aggregated value, gaps filled."""
    wide = df.groupBy(row).pivot(column, list(names)).agg(F.first(value))
    cells = [F.coalesce(F.col(f"`{v}`"), F.lit(float(fill))).alias(name) for v, name in names.items()]
    return wide.select(row, *cells)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency and share of each value. The counts are a small frame; their sum is a scalar."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    everything = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("pct", percent(F.col("n"), everything)).orderBy(F.desc("n"), column)


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per column.

    Quartiles are found by descent over counts, so no row is moved or ordered. A column
    without values has no row.
    """
    stats = {"count": F.count, "mean": mean, "std": lambda v: F.round(F.stddev(v), 2), "min": F.min, "max": F.max}
    quartiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    found = quantiles(df, columns, quartiles, stats)
    names = ["column", "count", "mean", "std", "min", *quartiles, "max"]
    schema = "column string, count bigint, " + ", ".join(f"{n} double" for n in names[2:])
    out = df.sparkSession.createDataFrame([tuple(r[n] for n in names) for r in found], schema)
    # Four digits hold any quartile of cents.
    return out.withColumns({q: F.round(q, 4) for q in quartiles})


def profile_columns(df: DataFrame) -> DataFrame:
    """Type, filled and empty count of every column from one pass."""
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.count(F.col(f"`{f.name}`")).alias("non_null"),
                F.count_if(F.col(f"`{f.name}`").isNull()).alias("nulls"),
            )
            for f in df.schema.fields
        ]
    )
    return df.agg(rows.alias("_p")).select(F.inline("_p"))


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Pearson correlation of every ordered pair, all pairs in one aggregate."""
    pair = {p: F.corr(as_double(p[0]), as_double(p[1])) for p in combinations(columns, 2)}

    def value(a: str, b: str) -> Column:
        if a == b:
            return F.lit(1.0)
        return F.round(pair[(a, b)] if (a, b) in pair else pair[(b, a)], digits)

    rows = [
        F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"), value(a, b).alias("corr"))
        for a in columns
        for b in columns
    ]
    return df.agg(F.array(*rows).alias("_m")).select(F.inline("_m"))


def histogram(df: DataFrame, value: str, bins: int, by: str) -> DataFrame:
    """Equal-width counts between each class's own extremes; the maximum is in the last bin.

    Empty bins are left out. The class extremes are joined back after a size check.
    """
    v = as_double(value)
    spans = df.groupBy(by).agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    rows = df.select(by, v.alias("_v")).filter("_v is not null").join(spans, by)
    width = (F.col("_hi") - F.col("_lo")) / bins
    # A class with a single value has no width: all of it is in the first bin.
    place = F.when(width == 0, 1).otherwise(
        F.least(F.floor(F.try_divide(F.col("_v") - F.col("_lo"), width)) + 1, F.lit(bins))
    )
    return rows.groupBy(by, place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def risk_factor_table(df: DataFrame, factors: Mapping[str, str], n: int = 8) -> DataFrame:
    """Churn rate per value of several columns in one ranked list.

    Each column is grouped on the distinct combinations first, so the unpivot multiplies
    the combinations and not the table.
    """
    combos = df.groupBy(*factors.values()).agg(
        F.count(F.lit(1)).alias("_n"), churned_count().alias("_gone")
    )
    names = [
        F.concat(F.lit(f"{label}: "), F.col(column)) for label, column in factors.items()
    ]
    return (
        combos.select(F.explode(F.array(*names)).alias("factor"), "_n", "_gone")
        .groupBy("factor")
        .agg(
            percent(F.sum("_gone"), F.sum("_n")).alias("churn_rate_pct"),
            F.sum("_n").alias("customers"),
        )
        .orderBy(F.desc("churn_rate_pct"), "factor")
        .limit(n)
    )


def revenue_loss_share(df: DataFrame) -> DataFrame:
    gone, kept = F.col("churn") == 1, F.col("churn") == 0
    lost = F.sum(F.when(gone, money("monthly_charges")))
    return df.agg(
        total("monthly_charges").alias("total_revenue"),
        total_where(gone, "monthly_charges").alias("lost_revenue"),
        total_where(kept, "monthly_charges").alias("retained_revenue"),
        percent_of_money(lost, F.sum(money("monthly_charges"))).alias("loss_pct"),
    )


def arg_extreme(df: DataFrame, label: str, value: str) -> DataFrame:
    """Label at the highest and the lowest value; the smaller label wins a tie."""
    high = F.min_by(label, F.struct(-F.col(value), F.col(label)))
    low = F.min_by(label, F.struct(F.col(value), F.col(label)))
    return df.filter(F.col(value).isNotNull()).agg(high.alias("highest"), low.alias("lowest"))


def action_summary(df: DataFrame) -> DataFrame:
    """Customers, charges and mean score per action."""
    return df.groupBy("action").agg(
        F.count(F.lit(1)).alias("customers"),
        total("monthly_charges").alias("monthly_at_risk"),
        total(F.col("monthly_charges") * 12).alias("annual_at_risk"),
        mean("monthly_charges").alias("avg_monthly"),
        mean("risk_score", 1).alias("avg_risk"),
    )


def risk_label_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("risk_label").agg(
        F.count(F.lit(1)).alias("customers"),
        churned_count().alias("churned"),
        churn_rate().alias("churn_rate_pct"),
        mean("monthly_charges").alias("avg_monthly"),
        total("lifetime_value").alias("total_ltv"),
    )


def risk_band_summary(df: DataFrame) -> DataFrame:
    """Churn and mean score per band; a null score keeps its rows out of the mean only."""
    return df.groupBy("risk_band").agg(
        F.count(F.lit(1)).alias("customers"),
        churned_count().alias("actual_churned"),
        churn_rate().alias("churn_rate_pct"),
        mean("monthly_charges").alias("avg_monthly"),
        mean("total_risk_score", 1).alias("avg_risk_score"),
    )


def recovery_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("at_risk_customers"),
        total("monthly_charges").alias("monthly_revenue_at_risk"),
        mean("monthly_charges").alias("avg_monthly_charge"),
        total(F.col("monthly_charges") * 12).alias("annual_revenue_at_risk"),
    )


def top_counts(df: DataFrame, column: str, n: int = 10, min_count: int = 0) -> DataFrame:
    """Most frequent non-null values; the value itself breaks ties."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > min_count).orderBy(F.desc("n"), column).limit(n)


def words(df: DataFrame, text: str) -> DataFrame:
    """One row per blank-separated word of the whole text.

    Other blanks become spaces first: a split at one plain character costs half of a split
    by a regular expression.
    """
    spaced = F.col(text)
    for blank in "\t\n\x0b\f\r":
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    return df.select(F.explode(F.split(spaced, " ")).alias("word")).filter("word != ''")


def bin_open_low(df: DataFrame) -> DataFrame:
    """Customers and churn per year of tenure. The first band starts above 0, so a tenure
    of 0 and one beyond the last edge are in no band and drop out."""
    band = bin_right_closed(F.col("tenure"), YEAR_EDGES, YEAR_LABELS, include_lowest=False)
    return (
        df.withColumn("tenure_band", band)
        .filter(F.col("tenure_band").isNotNull())
        .groupBy("tenure_band")
        .agg(F.count(F.lit(1)).alias("customers"), churn_rate().alias("churn_pct"))
        .transform(in_band_order, "tenure_band", YEAR_LABELS)
    )
