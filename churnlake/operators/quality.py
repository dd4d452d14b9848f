"""Data quality and cleaning.

Checks are counted in one aggregate, not one job per check. Row rules are CASE
expressions beside the row, so a frame is split into valid and rejected without a second
scan of the source.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.functions.ladders import at_least, bin_right_closed, map_values
from churnlake.functions.numbers import percent, safe_cast
from churnlake.functions.scoring import (
    SALARY_BAND_DEFAULT,
    SALARY_BANDS,
    TENURE_EDGES,
    TENURE_LABELS,
    charge_band,
    churn_flag_truthy,
)
from churnlake.functions.text import contains_ignoring_case, title_case

Rules = Sequence[tuple[Column, Column | str]]

# What an HR record may hold.
DEPARTMENTS = ["Engineering", "Sales", "Marketing", "Finance", "HR", "Operations", "IT"]
SALARY_RANGE = (500, 50000)
# Contracts a staged customer may have.
KNOWN_CONTRACTS = ["Month-to-month", "One year", "Two year"]
# States a project may be in.
PROJECT_STATES = ["Completed", "Delayed", "In Progress"]
# Columns a raw customer file must have.
REQUIRED_COLUMNS = [
    "customerID",
    "Churn",
    "Contract",
    "tenure",
    "MonthlyCharges",
    "TotalCharges",
    "InternetService",
    "PaymentMethod",
]
# Share of invalid rows a run may carry.
MAX_INVALID = 0.05


class ValidationError(ValueError):
    """A run or a file that must not go on."""


def is_blank(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.isNull() | (F.trim(col.cast("string")) == "")


def quality_checks(df: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """One row: total, blank keys, rows per rule, repeated keys, and the overall flag.

    Rows are first summed per key, with partial sums in each task, so one scan and one
    shuffle serve every check and a key that repeats without end stays one row.
    """
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(cond).alias(name) for name, cond in rules.items()]
    )
    counts = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(F.when(is_blank(key), F.col("_n"))), F.lit(0)).alias("null_ids"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in rules],
        F.count_if(F.col("_n") > 1).alias("duplicate_ids"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("surplus_rows"),
    )
    failing = ["null_ids", *rules, "duplicate_ids"]
    passed = reduce(lambda a, b: a & b, [F.col(name) == 0 for name in failing])
    return counts.withColumn("all_passed", passed)


def customer_rules(charge: str = "monthly_charges", tenure: str = "tenure", churn: str = "churn") -> dict[str, Column]:
    return {
        "invalid_charges": F.col(charge) <= 0,
        "invalid_tenure": F.col(tenure) < 0,
        "invalid_churn": ~F.col(churn).isin(0, 1),
    }


def output_checks(df: DataFrame, key: str, labels: Sequence[str]) -> DataFrame:
    """Checks of an enriched frame; a null label counts as outside the set."""
    known = F.coalesce(F.col("risk_label").isin(*labels), F.lit(False))
    checks = {
        "null_scores": F.col("risk_score").isNull(),
        "negative_values": F.col("lifetime_value") < 0,
        "invalid_labels": ~known,
        "missing_ids": F.col(key).isNull(),
    }
    out = df.agg(F.count(F.lit(1)).alias("total_rows"), *[F.count_if(c).alias(n) for n, c in checks.items()])
    return out.withColumn("all_passed", reduce(lambda a, b: a & b, [F.col(n) == 0 for n in checks]))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def duplicate_summary(df: DataFrame, *keys: str) -> DataFrame:
    """Repeated keys, and rows beyond the first of each key; they differ from three up."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
    )


def required_columns(df: DataFrame, required: Sequence[str] = tuple(REQUIRED_COLUMNS)) -> list[str]:
    return [f"Missing column: {c}" for c in required if c not in df.columns]


def dataset_issues(df: DataFrame, required: Sequence[str], key: str, charge: str, tenure: str) -> list[str]:
    """Issue texts of a raw frame; a check whose column is missing is left out."""
    issues = required_columns(df, required)
    rules = {
        "Negative tenure values": (tenure, lambda c: c < 0),
        "Invalid MonthlyCharges values": (charge, lambda c: c <= 0),
    }
    usable = {text: test(F.col(c)) for text, (c, test) in rules.items() if c in df.columns}
    if key not in df.columns:
        return issues
    row = quality_checks(df, key, {f"_r{i}": cond for i, cond in enumerate(usable.values())}).first()
    if row["duplicate_ids"]:
        issues.append(f"Duplicate {key}s found")
    return issues + [text for i, text in enumerate(usable) if row[f"_r{i}"]]


def _reason(text: Column | str) -> Column:
    return F.lit(text) if isinstance(text, str) else text


def validate_records(df: DataFrame, rules: Rules, name: str = "reason") -> DataFrame:
    """Reason of the first failing rule per row, null when the row is valid."""
    return df.withColumn(name, F.coalesce(*[F.when(bad, _reason(text)) for bad, text in rules]))


def split_valid(df: DataFrame, name: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Valid rows without the reason column, and rejected rows with it."""
    return df.filter(F.col(name).isNull()).drop(name), df.filter(F.col(name).isNotNull())


def validate_all_reasons(df: DataFrame, rules: Rules, name: str = "issues") -> DataFrame:
    """Every failing rule per row, in rule order; empty when the row is valid."""
    found = F.array(*[F.when(bad, _reason(text)) for bad, text in rules])
    return df.withColumn(name, F.array_compact(found))


def validation_summary(df: DataFrame, name: str = "issues") -> DataFrame:
    """Counts and status of a frame checked by ``validate_all_reasons``."""
    bad = F.size(name) > 0
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(~bad).alias("valid"),
        F.count_if(bad).alias("invalid"),
        F.when(F.count_if(bad) == 0, "PASSED").otherwise("WARNINGS").alias("status"),
    )


def sample_issues(df: DataFrame, row: str, n: int = 3, name: str = "issues") -> DataFrame:
    """First failing rows in row order, for a report."""
    return df.filter(F.size(name) > 0).orderBy(row).limit(n)


def hr_rules() -> Rules:
    """Rules of an HR record in the order they are reported."""
    number = safe_cast("salary", "double")
    low, high = SALARY_RANGE
    department = F.upper(F.trim("department"))
    return [
        (is_blank("emp_id"), "Missing employee ID"),
        (is_blank("name"), "Missing employee name"),
        (
            ~F.coalesce(department.isin(*[d.upper() for d in DEPARTMENTS]), F.lit(False)),
            F.concat(F.lit("Invalid department: '"), F.coalesce("department", F.lit("")), F.lit("'")),
        ),
        (number.isNull(), F.concat(F.lit("Invalid salary: '"), F.coalesce("salary", F.lit("")), F.lit("'"))),
        (
            (number < low) | (number > high),
            F.concat(F.lit("Salary "), number.cast("string"), F.lit(f" out of range ({low}-{high})")),
        ),
    ]


def project_rules() -> Rules:
    cost = safe_cast("cost", "double")
    return [
        (is_blank("project_id"), "Missing ID"),
        (is_blank("service"), "Missing service type"),
        (F.coalesce(cost, F.lit(0.0)) <= 0, "Invalid cost"),
        (~F.coalesce(F.col("status").isin(*PROJECT_STATES), F.lit(False)), "Invalid status"),
    ]


def customer_file_rules(key: str = "customerID", charge: str = "MonthlyCharges", contract: str = "Contract") -> Rules:
    """Rules of an uploaded customer file; a missing charge is missing and non-numeric."""
    number = safe_cast(charge, "double")
    return [
        (F.coalesce(F.col(key), F.lit("")) == "", f"Missing {key}"),
        (F.coalesce(F.col(charge), F.lit("")) == "", f"Missing {charge}"),
        (F.coalesce(F.col(contract), F.lit("")) == "", f"Missing {contract}"),
        (number <= 0, "Invalid charge"),
        (number.isNull(), "Non-numeric charge"),
    ]


def staging_validation(staging: DataFrame, target: DataFrame, key: str, charge: str, contract: str) -> DataFrame:
    """Problems of staged rows in one row: blank id, charge, contract, already loaded."""
    known = target.select(F.col(key).alias("_known")).distinct()
    marked = staging.join(known, F.col(key) == F.col("_known"), "left")
    return marked.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_blank(key)).alias("missing_id"),
        F.count_if(F.col(charge) <= 0).alias("invalid_charge"),
        F.count_if(~F.col(contract).isin(*KNOWN_CONTRACTS)).alias("invalid_contract"),
        F.count_if(F.col("_known").isNotNull()).alias("duplicates"),
    )


def validation_report(checked: DataFrame, key: str, n: int = 3) -> DataFrame:
    """One row: counts, status, and the first ``n`` failing rows as ``key: issues``."""
    text = F.concat(F.col(key).cast("string"), F.lit(": "), F.array_join("issues", "; "))
    first = sample_issues(checked, key, n).select(F.struct(key, text.alias("text")).alias("row"))
    rows = first.agg(F.array_sort(F.collect_list("row")).alias("rows"))
    texts = rows.select(F.transform("rows", lambda r: r["text"]).alias("texts")).scalar()
    return validation_summary(checked).withColumn("first_issues", texts)


def invalid_share(df: DataFrame, name: str = "reason") -> DataFrame:
    """Counts behind the gate; the flag is false for an empty frame."""
    bad = F.count_if(F.col(name).isNotNull())
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("total_records"),
        bad.alias("invalid_records"),
        percent(bad, n, 2).alias("invalid_pct"),
        ((n > 0) & (bad < n * F.lit(MAX_INVALID))).alias("validation_passed"),
    )


def validation_gate(df: DataFrame, name: str = "reason") -> dict:
    """Run the count and stop the run unless less than 5 % of the rows are invalid."""
    row = invalid_share(df, name).first()
    if row["total_records"] == 0:
        raise ValidationError("No records to validate")
    if not row["validation_passed"]:
        raise ValidationError(f"{row['invalid_records']} of {row['total_records']} records are invalid")
    return row.asDict()


def clean_customers(df: DataFrame, charge_unit: float = 1) -> DataFrame:
    """Raw customer text to typed columns with bands, in one projection.

    Blank charges become 0, text columns but the id are trimmed, 0/1 becomes No/Yes and
    Yes/No becomes a flag. An unknown code gives null.
    """
    texts = {
        f.name: F.trim(f.name)
        for f in df.schema.fields
        if f.dataType.simpleString() == "string" and f.name not in ("customerID", "TotalCharges", "Churn")
    }
    out = df.withColumns(texts)
    charge = F.col("MonthlyCharges").cast("decimal(18,2)")
    fixed = {
        "TotalCharges": F.coalesce(safe_cast("TotalCharges", "double"), F.lit(0.0)),
        "SeniorCitizen": map_values(F.col("SeniorCitizen").cast("string"), {"0": "No", "1": "Yes"}),
        "Churn": map_values(F.trim("Churn"), {"Yes": True, "No": False}),
        "tenure_group": bin_right_closed(F.col("tenure"), TENURE_EDGES, TENURE_LABELS),
        "charge_band": charge_band(charge, charge_unit),
        "is_auto_pay": contains_ignoring_case("PaymentMethod", "automatic"),
        "lifetime_value": F.round(charge * F.col("tenure"), 2).cast("double"),
    }
    return out.withColumns(fixed)


def clean_projects(df: DataFrame, processed_at: str) -> DataFrame:
    return df.select(
        F.trim("project_id").alias("project_id"),
        F.trim("client_id").alias("client_id"),
        F.trim("service").alias("service"),
        safe_cast("cost", "int").alias("cost_ghs"),
        safe_cast("duration", "int").alias("duration_days"),
        safe_cast("satisfaction", "double").alias("satisfaction_score"),
        (F.col("repeat_client") == "Yes").alias("is_repeat_client"),
        F.trim("status").alias("completion_status"),
        F.lit(processed_at).alias("processed_at"),
    )


def clean_hr(df: DataFrame, processed_at: str) -> DataFrame:
    salary = safe_cast("salary", "double")
    return df.select(
        F.upper(F.trim("emp_id")).alias("emp_id"),
        title_case(F.trim("name")).alias("name"),
        title_case(F.trim("department")).alias("department"),
        salary.alias("salary_ghs"),
        title_case(F.trim("gender")).alias("gender"),
        safe_cast("years_experience", "int").alias("years_experience"),
        safe_cast("performance_score", "double").alias("performance_score"),
        (F.trim("is_active") == "Yes").alias("is_active"),
        at_least(salary, SALARY_BANDS, SALARY_BAND_DEFAULT).alias("salary_band"),
        F.lit(processed_at).alias("processed_at"),
    )


def churn_file_summary(df: DataFrame, contract: str = "Contract", churn: str = "Churn") -> DataFrame:
    """Churn of a text file; the same flag decides who is churned and who is retained."""
    gone = churn_flag_truthy(F.col(churn))
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("total_customers"),
        F.count_if(gone).alias("churned"),
        F.coalesce(percent(F.count_if(gone), n, 2), F.lit(0.0)).alias("churn_rate_pct"),
        F.count_if((F.col(contract) == "Month-to-month") & ~gone).alias("high_risk_retained"),
    )


def etl_standardise(df: DataFrame, processed_by: str, processed_at: str, run_id: str) -> DataFrame:
    """Trimmed text, empty charge as 0, rows with a charge that is no number left out."""
    charge = F.when(F.coalesce("MonthlyCharges", F.lit("")) == "", 0.0).otherwise(safe_cast("MonthlyCharges", "double"))
    return (
        df.select(
            F.trim(F.coalesce("customerID", F.lit(""))).alias("customerID"),
            F.trim(F.coalesce("Contract", F.lit(""))).alias("Contract"),
            charge.alias("MonthlyCharges"),
            F.trim(F.coalesce("Churn", F.lit(""))).alias("Churn"),
        )
        .filter(F.col("MonthlyCharges").isNotNull())
        .withColumns(
            {"processed_by": F.lit(processed_by), "processed_at": F.lit(processed_at), "job_run_id": F.lit(run_id)}
        )
    )


def issues_frame(spark: SparkSession, issues: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(i,) for i in issues], "issue string")
