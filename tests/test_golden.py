"""Published inputs and results, as literals."""

from decimal import Decimal

from compare import rows
from pyspark.sql import functions as F

from churnlake.functions import scoring
from churnlake.operators import aggregates, quality
from churnlake.plans import runs

# Customers on the published intervention list with their expected score and action.
TARGETS = [
    ("8016-NCFVO", 116.5, 55, 6, 6407.5, 2796.0, "Email campaign + contract upgrade"),
    ("9659-QEQSY", 115.65, 45, 7, 5204.25, 2775.6, "Immediate call + discount offer"),
    ("6710-HSJRD", 114.1, 61, 6, 6960.1, 2738.4, "Email campaign + contract upgrade"),
    ("0771-WLCLA", 112.95, 16, 8, 1807.2, 2710.8, "Immediate call + discount offer"),
    ("2587-EKXTS", 111.5, 44, 7, 4906.0, 2676.0, "Immediate call + discount offer"),
    ("3292-PBZEJ", 111.4, 11, 9, 1225.4, 2673.6, "Immediate call + discount offer"),
    ("6168-YBYNP", 111.35, 59, 6, 6569.65, 2672.4, "Email campaign + contract upgrade"),
    ("2067-QYTCF", 111.15, 64, 6, 7113.6, 2667.6, "Email campaign + contract upgrade"),
    ("6030-REHUX", 110.85, 28, 7, 3103.8, 2660.4, "Immediate call + discount offer"),
    ("1320-REHCS", 110.75, 52, 6, 5759.0, 2658.0, "Email campaign + contract upgrade"),
    ("7576-JMYWV", 110.2, 46, 7, 5069.2, 2644.8, "Immediate call + discount offer"),
    ("3174-RKMOW", 109.95, 35, 7, 3848.25, 2638.8, "Immediate call + discount offer"),
    ("4176-FXYBO", 109.55, 54, 6, 5915.7, 2629.2, "Email campaign + contract upgrade"),
    ("9278-VZKCD", 109.1, 52, 6, 5673.2, 2618.4, "Email campaign + contract upgrade"),
    ("9971-ZWPBF", 108.9, 34, 7, 3702.6, 2613.6, "Immediate call + discount offer"),
]

# Published customers and churned customers per contract and service.
SEGMENTS = [
    ("Month-to-month", "Fiber optic", 2128, 1162, 54.6, "🔴 Critical"),
    ("Month-to-month", "DSL", 1223, 394, 32.2, "🟡 High Risk"),
    ("One year", "Fiber optic", 539, 104, 19.3, "🟠 Medium Risk"),
    ("Month-to-month", "No", 524, 99, 18.9, "🟠 Medium Risk"),
    ("One year", "DSL", 570, 53, 9.3, "🟢 Low Risk"),
    ("Two year", "Fiber optic", 429, 31, 7.2, "🟢 Low Risk"),
    ("One year", "No", 364, 9, 2.5, "🟢 Low Risk"),
    ("Two year", "DSL", 628, 12, 1.9, "🟢 Low Risk"),
    ("Two year", "No", 638, 5, 0.8, "🟢 Low Risk"),
]
CONTRACTS = [("Month-to-month", 3875, 1655, 42.7), ("One year", 1473, 166, 11.3), ("Two year", 1695, 48, 2.8)]

HR_RAW = [
    ("EMP001", "Kofi Mensah", "Engineering", "8500", "Male", "5", "4.2", "Yes"),
    ("EMP002", "  Ama Asante  ", "sales", "6200", "Female", "3", "3.8", "Yes"),
    ("EMP003", "Kwame Boateng", "Finance", "-500", "Male", "7", "4.5", "Yes"),
    ("EMP004", "Abena Owusu", "Marketing", "7100", "Female", "4", "4.0", "No"),
    (None, "Yaw Darko", "IT", "9200", "Male", "6", "3.5", "Yes"),
    ("EMP006", "Efua Mensah", "HR", "5800", "Female", "2", "4.1", "Yes"),
    ("EMP007", "Kojo Asare", "Operations", "7500", "Male", "8", "4.7", "Yes"),
    ("EMP008", "Akosua Frimpong", "Engineering", "9500", "Female", "5", "4.3", "Yes"),
    ("EMP009", "Nana Adu", "UNKNOWN_DEPT", "6000", "Male", "3", "3.2", "Yes"),
    ("EMP010", "Adwoa Boateng", "Finance", "8800", "Female", "6", "4.6", "No"),
]
HR_COLUMNS = "emp_id string, name string, department string, salary string, gender string, years_experience string, performance_score string, is_active string"
HR_REJECTED = [
    ("EMP003", "Salary -500.0 out of range (500-50000)"),
    ("EMP009", "Invalid department: 'UNKNOWN_DEPT'"),
    (None, "Missing employee ID"),
]

PROJECTS = [
    ("PRJ_001", "C001", "Data Analytics", "22000", "30", "4", "Yes", "Completed"),
    ("PRJ_002", "C002", "Software Dev", "50000", "65", "2", "No", "Delayed"),
    ("PRJ_003", "C003", "Cloud Migration", "28000", "25", "5", "Yes", "Completed"),
    ("PRJ_004", "C004", "Cybersecurity Audit", "18000", "18", "3", "No", "Completed"),
    ("PRJ_005", "C005", "IT Support Package", "10000", "7", "4", "No", "Completed"),
    ("PRJ_006", "C006", "Website Development", "8000", "10", "3", "No", "Delayed"),
    ("PRJ_007", "C007", "IT Infrastructure", "35000", "40", "4", "Yes", "Completed"),
]
PROJECT_COLUMNS = "project_id string, client_id string, service string, cost string, duration string, satisfaction string, repeat_client string, status string"


def test_intervention_targets(spark):
    df = spark.createDataFrame(
        [(t[0], Decimal(str(t[1])), t[2], "Month-to-month", "Electronic check") for t in TARGETS],
        "customer_id string, monthly_charges decimal(18,2), tenure int, contract string, payment_method string",
    ).withColumn("risk_score", scoring.risk_score_full())
    got = df.select(
        "customer_id",
        "risk_score",
        scoring.lifetime_value().cast("double"),
        scoring.value_over(24).cast("double"),
        scoring.action_753(F.col("risk_score")),
    )
    assert rows(got) == sorted(((t[0], *t[3:]) for t in TARGETS), key=str)


def _population(spark):
    """One row per published customer."""
    df = spark.createDataFrame(
        [s[:4] for s in SEGMENTS], "contract string, internet_service string, n int, gone int"
    )
    each = df.select("contract", "internet_service", "gone", F.explode(F.sequence(F.lit(1), "n")).alias("i"))
    return each.select(
        "contract",
        "internet_service",
        F.when(F.col("i") <= F.col("gone"), 1).otherwise(0).alias("churn"),
        F.lit(1).cast("decimal(18,2)").alias("monthly_charges"),
    )


def test_churn_by_contract_of_the_published_population(spark):
    out = aggregates.churn_by(_population(spark), ["contract"], ["total", "churned", "churn_rate_pct"])
    assert rows(out) == CONTRACTS


def test_overall_churn_of_the_published_population(spark):
    row = runs.kpis(_population(spark)).first()
    assert (row["total_customers"], row["total_churned"], row["churn_rate_pct"]) == (7043, 1869, 26.54)


def test_segment_labels_of_the_published_population(spark):
    out = aggregates.segment_risk_matrix(_population(spark))
    got = rows(out, "contract", "internet_service", "customers", "churned", "churn_rate_pct", "risk_label")
    assert got == sorted(SEGMENTS, key=str)


def test_hr_records(spark):
    raw = spark.createDataFrame(HR_RAW, HR_COLUMNS)
    valid, rejected = quality.split_valid(quality.validate_records(raw, quality.hr_rules()))
    assert rows(rejected, "emp_id", "reason") == sorted(HR_REJECTED, key=str)
    clean = quality.clean_hr(valid, "2026-06-01 10:07:32")
    got = rows(clean, "emp_id", "name", "department", "salary_ghs", "is_active", "salary_band")
    assert got == [
        ("EMP001", "Kofi Mensah", "Engineering", 8500.0, True, "Senior"),
        ("EMP002", "Ama Asante", "Sales", 6200.0, True, "Mid"),
        ("EMP004", "Abena Owusu", "Marketing", 7100.0, False, "Mid"),
        ("EMP006", "Efua Mensah", "Hr", 5800.0, True, "Mid"),
        ("EMP007", "Kojo Asare", "Operations", 7500.0, True, "Mid"),
        ("EMP008", "Akosua Frimpong", "Engineering", 9500.0, True, "Senior"),
        ("EMP010", "Adwoa Boateng", "Finance", 8800.0, False, "Senior"),
    ]
    row = runs.hr_summary(clean).first()
    assert (row["total_employees"], row["active_employees"], row["avg_salary_ghs"]) == (7, 5, 7628.57)
    assert (row["max_salary_ghs"], row["min_salary_ghs"], row["avg_performance"]) == (9500.0, 5800.0, 4.24)
    assert row["salary_bands"] == {"Senior": 3, "Mid": 4, "Junior": 0}
    assert row["departments"] == {"Engineering": 2, "Sales": 1, "Marketing": 1, "Hr": 1, "Operations": 1, "Finance": 1}


def test_projects(spark):
    clean = quality.clean_projects(spark.createDataFrame(PROJECTS, PROJECT_COLUMNS), "2026-06-01 01:17:28")
    first = clean.orderBy("project_id").first()
    assert tuple(first)[3:8] == (22000, 30, 4.0, True, "Completed")
    row = runs.project_stats(clean).first()
    assert (row["total_projects"], row["total_revenue"], row["avg_cost"]) == (7, 171000, 24428.57)
    assert (row["completed"], row["delayed"], row["completion_rate"]) == (5, 2, 71.4)


def test_project_rules(spark):
    data = [("PRJ_001", "Data Analytics", "22000", "Completed"), ("", "Data Analytics", "-500", "Unknown")]
    df = spark.createDataFrame(data, "project_id string, service string, cost string, status string")
    out = quality.validate_all_reasons(df, quality.project_rules())
    assert [r["issues"] for r in out.orderBy(F.desc("project_id")).collect()] == [
        [],
        ["Missing ID", "Invalid cost", "Invalid status"],
    ]


def test_customer_sample(spark):
    data = [
        ("7590-VHVEG", "Month-to-month", 29.85, 0),
        ("5575-GNVDE", "One year", 56.95, 0),
        ("3668-QPYBK", "Month-to-month", 53.85, 1),
        ("7795-CFOCW", "One year", 42.30, 0),
        ("9237-HQITU", "Month-to-month", 70.70, 1),
        ("9305-CDSKC", "Month-to-month", 99.65, 1),
        ("1452-KIOVK", "Month-to-month", 89.10, 0),
        ("6713-OKOMC", "Month-to-month", 29.75, 0),
        ("7892-POOKP", "Month-to-month", 104.80, 1),
        ("0280-XJGEX", "Month-to-month", 103.70, 1),
    ]
    df = spark.createDataFrame([(a, b, str(c), str(d)) for a, b, c, d in data], "customerID string, Contract string, MonthlyCharges string, Churn string")
    assert rows(quality.churn_file_summary(df)) == [(10, 5, 50.0, 3)]
    assert quality.validation_summary(quality.validate_all_reasons(df, quality.customer_file_rules())).first()["status"] == "PASSED"
