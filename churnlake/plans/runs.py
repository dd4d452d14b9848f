"""Whole runs: extract, validate, transform, analyse, load, with status and errors kept.

Stages are functions over lazy frames. A run returns its report; it raises nothing, so a
scheduler can read the status.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.functions.numbers import mean, mean_where, percent, total, total_where
from churnlake.functions.scoring import lifetime_value, risk_label_753, risk_score_full
from churnlake.operators.quality import MAX_INVALID, ValidationError, customer_rules, validation_gate
from churnlake.operators.windows import rank_then_filter
from churnlake.plans.observed import checked_write, staged
from churnlake.sinks import versions
from churnlake.sinks.files import write_csv, write_json_report

log = logging.getLogger(__name__)

# Groups whose churn rates the insight report lists.
INSIGHT_GROUPS = {
    "churn_by_contract": "contract",
    "churn_by_tenure": "tenure_group",
    "churn_by_internet": "internet_service",
    "churn_by_payment": "payment_method",
}


@dataclass
class RunReport:
    """Outcome of a run: stages done, figures, and the error that ended it."""

    name: str
    status: str = "RUNNING"
    stages: list[str] = field(default_factory=list)
    metrics: dict[str, Any] = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)
    seconds: float = 0.0


def run_stages(name: str, stages: Mapping[str, Callable[[RunReport], None]]) -> RunReport:
    """Run the stages in order; the first failure ends the run and is recorded."""
    report, began = RunReport(name), time.monotonic()
    try:
        for stage, work in stages.items():
            work(report)
            report.stages.append(stage)
        report.status = "SUCCESS"
    except Exception as e:  # a run reports its failure, whatever the cause
        log.error("%s failed: %s", name, e)
        report.status = "FAILED"
        report.errors.append(str(e))
    report.seconds = round(time.monotonic() - began, 2)
    return report


def enriched(df: DataFrame) -> DataFrame:
    """Score, label and lifetime value beside each customer."""
    return df.withColumn("risk_score", risk_score_full()).withColumns(
        {"risk_label": risk_label_753(F.col("risk_score")), "lifetime_value": lifetime_value()}
    )


def top_priority(df: DataFrame, n: int = 10) -> DataFrame:
    """Retained customers among the ``n`` dearest of the critical label."""
    keep = (F.col("risk_label") == "Critical") & (F.col("churn") == 0)
    ranked = rank_then_filter(df, "risk_label", [("monthly_charges", "desc")], n, keep, "rank_in_segment")
    return ranked.select(
        "customer_id", "contract", "monthly_charges", "tenure", "risk_score", "lifetime_value", "rank_in_segment"
    )


def kpis(df: DataFrame) -> DataFrame:
    gone = F.col("churn") == 1
    return df.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(gone).alias("total_churned"),
        percent(F.count_if(gone), F.count(F.lit(1)), 2).alias("churn_rate_pct"),
        total("monthly_charges").alias("monthly_revenue"),
        total_where(gone, "monthly_charges").alias("revenue_at_risk"),
    )


def _invalid(key: str = "customer_id") -> Column:
    """Rows without a customer or with impossible figures."""
    number = lambda c: F.coalesce(F.col(c) >= 0, F.lit(False))
    return F.col(key).isNull() | ~number("monthly_charges") | ~number("tenure")


def gate(df: DataFrame) -> dict[str, Any]:
    """Share of invalid rows of a frame, checked against the limit."""
    row = validation_gate(df.withColumn("reason", F.when(_invalid(), "invalid")))
    return {"invalid_records": row["invalid_records"]}


def _passes(total: int, invalid: int) -> None:
    """The gate on counts that are known already."""
    if total == 0:
        raise ValidationError("No records to validate")
    if not invalid < total * MAX_INVALID:
        raise ValidationError(f"{invalid} of {total} records are invalid")


def kpi_metrics() -> dict[str, Column]:
    """The headline figures as metrics of a write."""
    gone, charge = F.col("churn") == 1, F.col("monthly_charges").cast("decimal(18,2)")
    return {
        "total_churned": F.count_if(gone),
        "monthly_revenue": F.sum(charge),
        "revenue_at_risk": F.sum(F.when(gone, charge).otherwise(F.lit(0).cast("decimal(18,2)"))),
    }


def _report_of(spark: SparkSession, seen: Mapping[str, Any]) -> DataFrame:
    """The headline figures as a frame of one row."""
    names = ["total_records", "total_churned", "monthly_revenue", "revenue_at_risk"]
    row = [tuple(seen[n] for n in names)]
    known = spark.createDataFrame(row, "total_customers bigint, total_churned bigint, revenue decimal(28,2), risk decimal(28,2)")
    return known.select(
        "total_customers",
        "total_churned",
        percent(F.col("total_churned"), F.col("total_customers"), 2).alias("churn_rate_pct"),
        F.col("revenue").cast("double").alias("monthly_revenue"),
        F.col("risk").cast("double").alias("revenue_at_risk"),
    )


def churn_run(spark: SparkSession, read: Callable[[], DataFrame], out: str, run_at: str) -> RunReport:
    """The standard run: read, score, stage, check, publish, rank, summarise.

    The source is computed once: the scored rows are written to a staging path, and the
    counts of all checks, the gate's share of invalid rows and the headline figures come out
    of that write. Only if the gate holds are they published, as the current version under
    ``out/enriched``; else they are deleted, and readers keep what was there. The ranking reads the
    published columns that it needs.
    """
    state: dict[str, Any] = {}
    root = f"{out}/enriched"

    def extract(report: RunReport) -> None:
        state["rows"] = read()

    def check(report: RunReport) -> None:
        more = {"invalid_records": F.count_if(_invalid()), **kpi_metrics()}
        path, seen = checked_write(enriched(state["rows"]), root, "customer_id", customer_rules(), more)
        state.update(path=path, seen=seen)
        try:
            _passes(seen["total_records"], seen["invalid_records"])
        except ValidationError:
            versions.discard(spark, path)
            raise
        report.metrics["data_quality"] = "ALL PASSED" if seen["all_passed"] else "ISSUES FOUND"
        report.metrics |= {name: seen[name] for name in ("total_records", "invalid_records")}

    def save(report: RunReport) -> None:
        versions.publish(spark, root, state["path"])
        kept = spark.read.schema(enriched(state["rows"]).schema).parquet(state["path"])
        write_csv(top_priority(kept), f"{out}/top_priority")
        summary = _report_of(spark, state["seen"])
        write_json_report(summary.withColumn("run_at", F.lit(run_at)), f"{out}/report")
        report.metrics["executive_summary"] = summary.first().asDict()

    return run_stages("churn run", {"extract": extract, "quality": check, "transform and load": save})


def multi_source_ingest(
    spark: SparkSession, sources: Mapping[str, Callable[[], DataFrame]], landing: str
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Copy every source to a folder of ``landing``; one that fails is reported with a warning
    and left out, wherever it fails.

    A source is read once: its rows are counted by the write, and later stages read the copy.
    """
    frames, rows = {}, []
    for name, read in sources.items():
        try:
            df = read()
            path, seen = staged(df, f"{landing}/{name}", {"rows": F.count(F.lit(1))})
            frames[name] = spark.read.schema(df.schema).parquet(path)
            rows.append((name, "SUCCESS", seen["rows"], None))
        except Exception as e:  # sources fail alone
            log.warning("source %s: %s", name, e)
            condition = getattr(e, "getCondition", lambda: None)()
            rows.append((name, "WARNING", None, condition or type(e).__name__))
    return frames, spark.createDataFrame(rows, "source string, status string, rows bigint, message string")


def _rates(key: str) -> Column:
    """Map of group to churn rate over a frame already grouped by ``key``."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key), F.col("_rate"))))
    return F.map_from_entries(entries)


def insights(df: DataFrame) -> DataFrame:
    """One report row: headline figures, a map of churn rates per grouping, and the extremes.

    The table is read twice: once for the figures, once for the counts per combination of
    the four groupings. Their number is fixed by the domain; every map is built from those
    few rows.
    """
    gone, kept = F.col("churn") == 1, F.col("churn") == 0
    keys = list(INSIGHT_GROUPS.values())
    combos = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count_if(gone).alias("_gone")))
    out = df.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(gone).alias("churned_customers"),
        F.count_if(kept).alias("retained_customers"),
        percent(F.count_if(gone), F.count(F.lit(1)), 2).alias("churn_rate_pct"),
        total_where(gone, "monthly_charges").alias("monthly_revenue_at_risk"),
        mean_where(gone, "monthly_charges", 2).alias("avg_monthly_charge_churned"),
        mean_where(kept, "monthly_charges", 2).alias("avg_monthly_charge_retained"),
    )
    for name, key in INSIGHT_GROUPS.items():
        rates = combos.groupBy(key).agg(percent(F.sum("_gone"), F.sum("_n")).alias("_rate"))
        out = out.withColumn(name, rates.agg(_rates(key)).scalar())
        if key == "contract":
            out = out.withColumns(
                {
                    "top_risk_factor": rates.agg(F.min_by(key, F.struct(-F.col("_rate"), F.col(key)))).scalar(),
                    "safest_contract": rates.agg(F.min_by(key, F.struct(F.col("_rate"), F.col(key)))).scalar(),
                }
            )
    return out


def project_stats(df: DataFrame) -> DataFrame:
    """Totals of cleaned projects; an empty frame gives 0 projects and null means."""
    done = F.col("completion_status") == "Completed"
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("total_projects"),
        F.sum(F.col("cost_ghs").cast("bigint")).alias("total_revenue"),
        mean("cost_ghs").alias("avg_cost"),
        F.count_if(done).alias("completed"),
        F.count_if(F.col("completion_status") == "Delayed").alias("delayed"),
        percent(F.count_if(done), n).alias("completion_rate"),
    )


def hr_summary(df: DataFrame, bands: tuple[str, ...] = ("Senior", "Mid", "Junior")) -> DataFrame:
    """Salary figures with head counts per department and per band, bands without staff as 0."""
    per_department = df.groupBy("department").agg(F.count(F.lit(1)).alias("n"))
    departments = per_department.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("department", "n"))))
    )
    counts = [x for b in bands for x in (F.lit(b), F.count_if(F.col("salary_band") == b))]
    return df.agg(
        F.count(F.lit(1)).alias("total_employees"),
        F.count_if("is_active").alias("active_employees"),
        mean("salary_ghs").alias("avg_salary_ghs"),
        F.max("salary_ghs").alias("max_salary_ghs"),
        F.min("salary_ghs").alias("min_salary_ghs"),
        mean("performance_score").alias("avg_performance"),
        F.create_map(*counts).alias("salary_bands"),
    ).withColumn("departments", departments.scalar())
