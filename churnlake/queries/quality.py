"""Checks and cleaning bound to the tables."""

from pyspark.sql import functions as F

from churnlake.functions.numbers import as_double, total
from churnlake.operators import quality as op
from churnlake.plans import observed
from churnlake.plans.bounded import scratch_path
from churnlake.queries import sql as q
from churnlake.queries.registry import register
from churnlake.queries.scored import scored
from churnlake.sinks import versions
from churnlake.sources.subscriptions import subscriptions as subs
from churnlake.sources.tables import table

AT = "2026-01-01 00:00:00"


@register("quality_checks", q.subs(
    """SELECT COUNT(*) AS total_records, CAST(COUNT_IF(customer_id IS NULL) AS BIGINT) AS null_ids,
       CAST(COUNT_IF(monthly_charges <= 0) AS BIGINT) AS invalid_charges, CAST(COUNT_IF(tenure < 0) AS BIGINT) AS invalid_tenure,
       CAST(COUNT_IF(churn NOT IN (0, 1)) AS BIGINT) AS invalid_churn,
       (SELECT COUNT(*) FROM (SELECT customer_id FROM subs GROUP BY 1 HAVING COUNT(*) > 1) d) AS duplicate_ids,
       COUNT(*) - COUNT(DISTINCT customer_id) AS surplus_rows, TRUE AS all_passed FROM subs"""))
def quality_checks(spark, base):
    return op.quality_checks(subs(spark, base), "customer_id", op.customer_rules())


@register("quality_checks_on_write", q.subs(
    """SELECT COUNT(*) AS total_records, CAST(COUNT_IF(customer_id IS NULL) AS BIGINT) AS null_ids,
       CAST(COUNT_IF(monthly_charges <= 0) AS BIGINT) AS invalid_charges, CAST(COUNT_IF(tenure < 0) AS BIGINT) AS invalid_tenure,
       CAST(COUNT_IF(churn NOT IN (0, 1)) AS BIGINT) AS invalid_churn,
       (SELECT COUNT(*) FROM (SELECT customer_id FROM subs GROUP BY 1 HAVING COUNT(*) > 1) d) AS duplicate_ids,
       COUNT(*) - COUNT(DISTINCT customer_id) AS surplus_rows, TRUE AS all_passed,
       COUNT(*) AS stored_records, CAST(SUM(monthly_charges) AS DOUBLE) AS stored_revenue FROM subs"""))
def quality_checks_on_write(spark, base):
    """The checks taken by the write that stores the rows, beside what was stored."""
    root = scratch_path(spark, "checked")
    path, seen = observed.checked_write(subs(spark, base), root, "customer_id", op.customer_rules())
    versions.publish(spark, root, path)
    stored = versions.read_current(spark, root).agg(F.count(F.lit(1)).alias("stored_records"), total("monthly_charges").alias("stored_revenue"))
    told = [F.lit(v).cast("boolean" if n == "all_passed" else "bigint").alias(n) for n, v in seen.items()]
    return stored.select(*told, "stored_records", "stored_revenue")


_LINE_RULES = {"free_items": "l_extendedprice <= 0", "no_discount": "l_discount < 0.01"}


@register("quality_checks_failing",
    """SELECT COUNT(*) AS total_records, CAST(COUNT_IF(l_orderkey IS NULL) AS BIGINT) AS null_ids,
       CAST(COUNT_IF(l_extendedprice <= 0) AS BIGINT) AS free_items, CAST(COUNT_IF(l_discount < 0.01) AS BIGINT) AS no_discount,
       (SELECT COUNT(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1) d) AS duplicate_ids,
       COUNT(*) - COUNT(DISTINCT l_orderkey) AS surplus_rows, FALSE AS all_passed FROM lineitem""")
def quality_checks_failing(spark, base):
    lines = table(spark, base, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    return op.quality_checks(lines, "l_orderkey", {n: F.expr(c) for n, c in _LINE_RULES.items()})


@register("output_checks", q.subs(
    f"""SELECT COUNT(*) AS total_rows, CAST(0 AS BIGINT) AS null_scores, CAST(0 AS BIGINT) AS negative_values,
        CAST(COUNT_IF({q.SCORE} < 3) AS BIGINT) AS invalid_labels, CAST(COUNT_IF(customer_id IS NULL) AS BIGINT) AS missing_ids,
        COUNT_IF({q.SCORE} < 3) = 0 AS all_passed FROM subs"""))
def output_checks(spark, base):
    return op.output_checks(scored(spark, base), "customer_id", ["Critical", "High", "Medium"])


@register("duplicate_keys", "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1")
def duplicate_keys(spark, base):
    return op.duplicate_keys(table(spark, base, "orders"), "o_custkey")


@register("duplicate_summary",
    """SELECT CAST(COUNT_IF(n > 1) AS BIGINT) AS repeated_keys, CAST(SUM(n - 1) AS BIGINT) AS surplus_rows
       FROM (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2) t""")
def duplicate_summary(spark, base):
    return op.duplicate_summary(table(spark, base, "lineitem"), "l_orderkey", "l_linenumber")


@register("required_columns",
    """SELECT 'Missing column: ' || c AS issue FROM (VALUES ('customerID'), ('Churn'), ('Contract'), ('tenure'), ('MonthlyCharges'),
       ('TotalCharges'), ('InternetService'), ('PaymentMethod')) v(c)
       WHERE LOWER(c) NOT IN (SELECT 'churn' UNION SELECT 'contract' UNION SELECT 'tenure')
       UNION ALL SELECT 'Duplicate owner_ids found' WHERE (SELECT COUNT(*) - COUNT(DISTINCT o_custkey) FROM orders) > 0""")
def required_columns(spark, base):
    df = subs(spark, base).withColumnsRenamed({"churn": "Churn", "contract": "Contract"})
    issues = op.dataset_issues(df, op.REQUIRED_COLUMNS, "owner_id", "monthly_charges", "tenure")
    return op.issues_frame(spark, issues)


def _hr(spark, base):
    """Customers as raw HR text: untidy names, a balance as salary, a segment as department."""
    c = table(spark, base, "customer")
    return c.select(
        F.when(F.col("c_custkey") % 10 == 9, " ").otherwise(F.concat(F.lit(" emp"), F.col("c_custkey").cast("string"))).alias("emp_id"),
        F.concat(F.lit(" "), F.upper("c_name"), F.lit(" ")).alias("name"),
        F.when(F.col("c_mktsegment") == "BUILDING", " engineering").when(F.col("c_mktsegment") == "MACHINERY", "Sales ")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "hr").when(F.col("c_mktsegment") == "FURNITURE", "Marketing").otherwise(F.col("c_mktsegment")).alias("department"),
        F.when(F.col("c_nationkey") == 7, "n/a").otherwise(F.col("c_acctbal").cast("decimal(18,2)").cast("string")).alias("salary"),
        F.when(F.col("c_custkey") % 2 == 0, " FEMALE").otherwise("male ").alias("gender"),
        F.col("c_nationkey").cast("string").alias("years_experience"),
        (F.col("c_nationkey") / 5).cast("string").alias("performance_score"),
        F.when(F.col("c_acctbal") > 0, "Yes").otherwise("No").alias("is_active"),
    )


_HR = """hr AS (SELECT c_custkey, c_nationkey, c_name, c_custkey % 10 = 9 AS no_id, c_nationkey = 7 AS no_salary,
  CASE c_mktsegment WHEN 'BUILDING' THEN ' engineering' WHEN 'MACHINERY' THEN 'Sales ' WHEN 'HOUSEHOLD' THEN 'hr' WHEN 'FURNITURE' THEN 'Marketing' ELSE c_mktsegment END AS department,
  CAST(c_acctbal AS DECIMAL(18,2)) AS salary FROM customer),
hr_checked AS (SELECT *, CASE WHEN no_id THEN 'Missing employee ID'
  WHEN UPPER(TRIM(department)) NOT IN ('ENGINEERING', 'SALES', 'MARKETING', 'FINANCE', 'HR', 'OPERATIONS', 'IT') THEN 'Invalid department: ''' || department || ''''
  WHEN no_salary THEN 'Invalid salary: ''n/a'''
  WHEN salary < 500 OR salary > 50000 THEN 'Salary out of range' END AS reason FROM hr)"""


@register("validate_records", q.with_(
    "SELECT COALESCE(reason, 'valid') AS reason, COUNT(*) AS n FROM hr_checked GROUP BY 1", _HR))
def validate_records(spark, base):
    checked = op.validate_records(_hr(spark, base), op.hr_rules())
    short = F.when(F.col("reason").startswith("Salary "), "Salary out of range").otherwise(F.coalesce("reason", F.lit("valid")))
    return checked.groupBy(short.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def _title(x):
    return f"UPPER({x}[1]) || LOWER({x}[2:])"


@register("clean_hr", q.with_(
    f"""SELECT 'EMP' || c_custkey AS emp_id, {_title('c_name')} AS name, {_title('TRIM(department)')} AS department, CAST(salary AS DOUBLE) AS salary_ghs,
        CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender, CAST(c_nationkey AS INTEGER) AS years_experience,
        CAST(c_nationkey AS DOUBLE) / 5 AS performance_score, salary > 0 AS is_active,
        CASE WHEN salary >= 8000 THEN 'Senior' WHEN salary >= 5000 THEN 'Mid' ELSE 'Junior' END AS salary_band, '{AT}' AS processed_at
        FROM hr_checked WHERE reason IS NULL""", _HR))
def clean_hr(spark, base):
    valid, _ = op.split_valid(op.validate_records(_hr(spark, base), op.hr_rules()))
    return op.clean_hr(valid, AT)


def _customer_text(spark, base):
    """Orders as uploaded customer text with gaps."""
    o = table(spark, base, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string")).alias("customerID"),
        F.when(F.col("o_orderpriority") == "5-LOW", "").when(F.col("o_orderpriority") == "2-HIGH", "abc")
        .otherwise((F.col("o_totalprice") - 20000).cast("decimal(18,2)").cast("string")).alias("MonthlyCharges"),
        F.when(F.col("o_orderstatus") == "F", "Month-to-month").when(F.col("o_orderstatus") == "O", "").otherwise("Two year").alias("Contract"),
        F.when(F.col("o_orderpriority") == "1-URGENT", " True").when(F.col("o_orderpriority") == "3-MEDIUM", "1").otherwise("0").alias("Churn"),
    )


_TEXT = """t AS (SELECT o_orderkey, o_orderstatus = 'P' AS no_id, o_orderstatus = 'O' AS no_contract, o_orderpriority = '5-LOW' AS no_charge,
  o_orderpriority = '2-HIGH' AS bad_charge, CAST(o_totalprice - 20000 AS DECIMAL(18,2)) AS charge, o_orderpriority, o_orderstatus FROM orders),
checked AS (SELECT *, CONCAT_WS('; ', CASE WHEN no_id THEN 'Missing customerID' END, CASE WHEN no_charge THEN 'Missing MonthlyCharges' END,
  CASE WHEN no_contract THEN 'Missing Contract' END, CASE WHEN NOT no_charge AND NOT bad_charge AND charge <= 0 THEN 'Invalid charge' END,
  CASE WHEN no_charge OR bad_charge THEN 'Non-numeric charge' END) AS issues FROM t)"""


@register("validate_all_reasons", q.with_("SELECT o_orderkey, issues FROM checked", _TEXT))
def validate_all_reasons(spark, base):
    checked = op.validate_all_reasons(_customer_text(spark, base), op.customer_file_rules())
    return checked.select("o_orderkey", F.array_join("issues", "; ").alias("issues"))


@register("validate_all_summary", q.with_(
    """SELECT COUNT(*) AS total_records, CAST(COUNT_IF(issues = '') AS BIGINT) AS valid, CAST(COUNT_IF(issues <> '') AS BIGINT) AS invalid,
       'WARNINGS' AS status FROM checked""", _TEXT))
def validate_all_summary(spark, base):
    return op.validation_summary(op.validate_all_reasons(_customer_text(spark, base), op.customer_file_rules()))


@register("sample_issues", q.with_("SELECT o_orderkey, issues FROM checked WHERE issues <> '' ORDER BY o_orderkey LIMIT 3", _TEXT))
def sample_issues(spark, base):
    checked = op.validate_all_reasons(_customer_text(spark, base), op.customer_file_rules())
    return op.sample_issues(checked, "o_orderkey").select("o_orderkey", F.array_join("issues", "; ").alias("issues"))


@register("validation_report", q.with_(
    """SELECT COUNT(*) AS total_records, CAST(COUNT_IF(issues = '') AS BIGINT) AS valid, CAST(COUNT_IF(issues <> '') AS BIGINT) AS invalid,
       'WARNINGS' AS status, (SELECT STRING_AGG(o_orderkey || ': ' || issues, ' | ' ORDER BY o_orderkey)
         FROM (SELECT o_orderkey, issues FROM checked WHERE issues <> '' ORDER BY o_orderkey LIMIT 3) f) AS first_issues FROM checked""", _TEXT))
def validation_report(spark, base):
    checked = op.validate_all_reasons(_customer_text(spark, base), op.customer_file_rules())
    return op.validation_report(checked, "o_orderkey").withColumn("first_issues", F.array_join("first_issues", " | "))


@register("validation_gate", q.with_(
    f"""SELECT COUNT(*) AS total_records, CAST(COUNT_IF(reason IS NOT NULL) AS BIGINT) AS invalid_records,
        {q.pct('COUNT_IF(reason IS NOT NULL)', 'COUNT(*)', 2)} AS invalid_pct, COUNT_IF(reason IS NOT NULL) < COUNT(*) * 0.05 AS validation_passed FROM hr_checked""", _HR))
def validation_gate(spark, base):
    return op.invalid_share(op.validate_records(_hr(spark, base), op.hr_rules()))


@register("churn_flag_truthy", q.with_(
    f"""SELECT COUNT(*) AS total_customers, CAST(COUNT_IF(gone) AS BIGINT) AS churned, {q.pct('COUNT_IF(gone)', 'COUNT(*)', 2)} AS churn_rate_pct,
        CAST(COUNT_IF(o_orderstatus = 'F' AND NOT gone) AS BIGINT) AS high_risk_retained
        FROM (SELECT *, o_orderpriority IN ('1-URGENT', '3-MEDIUM') AS gone FROM t) g""", _TEXT))
def churn_flag_truthy(spark, base):
    return op.churn_file_summary(_customer_text(spark, base))


@register("etl_standardise", q.with_(
    f"""SELECT CASE WHEN no_id THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS "customerID",
        CASE o_orderstatus WHEN 'F' THEN 'Month-to-month' WHEN 'O' THEN '' ELSE 'Two year' END AS "Contract",
        CASE WHEN no_charge THEN 0 ELSE CAST(charge AS DOUBLE) END AS "MonthlyCharges",
        CASE o_orderpriority WHEN '1-URGENT' THEN 'True' WHEN '3-MEDIUM' THEN '1' ELSE '0' END AS "Churn",
        'etl' AS processed_by, '{AT}' AS processed_at, 'run-1' AS job_run_id FROM t WHERE NOT bad_charge""", _TEXT))
def etl_standardise(spark, base):
    return op.etl_standardise(_customer_text(spark, base), "etl", AT, "run-1")


@register("clean_customers", q.subs(
    f"""SELECT CAST(customer_id AS VARCHAR) AS "customerID", contract AS "Contract", COALESCE(CAST(total_charges AS DOUBLE), 0) AS "TotalCharges",
        senior_citizen AS "SeniorCitizen", churn = 1 AS "Churn", payment_method ILIKE '%automatic%' AS is_auto_pay,
        CASE WHEN tenure <= 12 THEN '0-12 months' WHEN tenure <= 24 THEN '13-24 months' WHEN tenure <= 48 THEN '25-48 months' WHEN tenure <= 72 THEN '49+ months' END AS tenure_group,
        CASE WHEN monthly_charges < {35 * q.UNIT} THEN 'Low (<$35)' WHEN monthly_charges < {65 * q.UNIT} THEN 'Medium ($35-65)'
             WHEN monthly_charges < {90 * q.UNIT} THEN 'High ($65-90)' ELSE 'Premium (>$90)' END AS charge_band,
        CAST(monthly_charges * tenure AS DOUBLE) AS lifetime_value FROM subs"""))
def clean_customers(spark, base):
    raw = subs(spark, base, "customer_id", "contract", "payment_method", "tenure", "monthly_charges", "total_charges", "senior_citizen", "churn").select(
        F.col("customer_id").cast("string").alias("customerID"),
        F.concat(F.lit(" "), "contract").alias("Contract"),
        F.concat("payment_method", F.lit("  ")).alias("PaymentMethod"),
        "tenure",
        as_double("monthly_charges").alias("MonthlyCharges"),
        F.coalesce(F.col("total_charges").cast("string"), F.lit(" ")).alias("TotalCharges"),
        F.when(F.col("senior_citizen") == "Yes", 1).otherwise(0).alias("SeniorCitizen"),
        F.when(F.col("churn") == 1, "Yes ").otherwise("No").alias("Churn"),
    )
    return op.clean_customers(raw, q.UNIT).drop("PaymentMethod", "tenure", "MonthlyCharges")


@register("clean_projects",
    f"""SELECT 'PRJ_' || o_orderkey AS project_id, 'C' || o_custkey AS client_id, o_orderpriority AS service, CAST(FLOOR(o_totalprice) AS INTEGER) AS cost_ghs,
        CAST(MONTH(o_orderdate) AS INTEGER) AS duration_days, CAST(MONTH(o_orderdate) AS DOUBLE) / 2 AS satisfaction_score,
        o_orderstatus = 'F' AS is_repeat_client, CASE o_orderstatus WHEN 'F' THEN 'Completed' ELSE 'Delayed' END AS completion_status, '{AT}' AS processed_at FROM orders""")
def clean_projects(spark, base):
    raw = _projects(spark, base)
    return op.clean_projects(raw, AT)


def _projects(spark, base):
    o = table(spark, base, "orders")
    month = F.month("o_orderdate")
    return o.select(
        F.concat(F.lit(" PRJ_"), F.col("o_orderkey").cast("string")).alias("project_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string"), F.lit(" ")).alias("client_id"),
        F.col("o_orderpriority").alias("service"),
        F.floor("o_totalprice").cast("string").alias("cost"),
        month.cast("string").alias("duration"),
        (month / 2).cast("string").alias("satisfaction"),
        F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No").alias("repeat_client"),
        F.when(F.col("o_orderstatus") == "F", " Completed").otherwise("Delayed").alias("status"),
    )
