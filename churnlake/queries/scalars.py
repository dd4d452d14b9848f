"""Scalar functions bound to the tables."""

from pyspark.sql import functions as F

from churnlake.functions import ladders, numbers, scoring, text
from churnlake.functions.numbers import as_double
from churnlake.operators import aggregates
from churnlake.queries import sql as q
from churnlake.queries.registry import register
from churnlake.queries.scored import scored
from churnlake.sources.calendar import dim_date
from churnlake.sources.subscriptions import subscriptions as subs
from churnlake.sources.tables import table

U = q.UNIT


@register("string_case_length", q.subs(
    """SELECT customer_id, UPPER(contract) AS contract_upper, LOWER(internet_service) AS internet_lower,
       CAST(LENGTH(payment_method) AS INTEGER) AS method_length FROM subs"""))
def string_case_length(spark, base):
    return subs(spark, base, "customer_id", "contract", "internet_service", "payment_method").select(
        "customer_id",
        F.upper("contract").alias("contract_upper"),
        F.lower("internet_service").alias("internet_lower"),
        F.length("payment_method").alias("method_length"),
    )


@register("string_substr_replace", q.subs(
    """SELECT customer_id, SUBSTR(payment_method, 1, 4) AS prefix, REPLACE(payment_method, ' (automatic)', '') AS clean_payment FROM subs"""))
def string_substr_replace(spark, base):
    return subs(spark, base, "customer_id", "payment_method").select(
        "customer_id",
        F.substring("payment_method", 1, 4).alias("prefix"),
        F.replace("payment_method", F.lit(" (automatic)"), F.lit("")).alias("clean_payment"),
    )


@register("payment_category", q.subs(
    f"""SELECT REPLACE(payment_method, ' (automatic)', '') AS payment_type,
        CASE WHEN payment_method ILIKE '%automatic%' THEN 'Auto-pay' ELSE 'Manual' END AS pay_category,
        COUNT(*) AS customers, {q.RATE} AS churn_rate_pct FROM subs GROUP BY payment_method"""))
def payment_category(spark, base):
    by_method = aggregates.churn_by(
        subs(spark, base, "payment_method", "churn"), ["payment_method"], ["customers", "churn_rate_pct"], "customers"
    )
    return by_method.select(
        F.replace("payment_method", F.lit(" (automatic)"), F.lit("")).alias("payment_type"),
        F.when(text.contains_ignoring_case("payment_method", "automatic"), "Auto-pay").otherwise("Manual").alias("pay_category"),
        "customers",
        "churn_rate_pct",
    )


@register("string_trim_title",
    """SELECT p_partkey, TRIM('  ' || UPPER(p_name) || ' ') AS trimmed,
       ARRAY_TO_STRING([UPPER(w[1]) || LOWER(w[2:]) FOR w IN STRING_SPLIT(p_name, ' ')], ' ') || '-'
         || UPPER(p_type[1]) || LOWER(p_type[2:]) AS titled FROM part""")
def string_trim_title(spark, base):
    part = table(spark, base, "part").select("p_partkey", "p_name", "p_type")
    raw = F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))
    return part.select(
        "p_partkey",
        F.trim(raw).alias("trimmed"),
        text.title_case(F.concat_ws("-", F.upper("p_name"), "p_type")).alias("titled"),
    )


@register("math_round_abs_cast", q.subs(
    f"""SELECT customer_id, CAST(ABS(monthly_charges - {65 * U}) AS DOUBLE) AS diff_from_level,
        CAST(tenure AS DOUBLE) / 12 AS tenure_years, CAST(monthly_charges * 12 AS DOUBLE) AS annual_value FROM subs"""))
def math_round_abs_cast(spark, base):
    return subs(spark, base, "customer_id", "monthly_charges", "tenure").select(
        "customer_id",
        as_double(F.abs(F.col("monthly_charges") - 65 * U)).alias("diff_from_level"),
        (F.col("tenure").cast("double") / 12).alias("tenure_years"),
        as_double(scoring.value_over(12)).alias("annual_value"),
    )


@register("scalar_min_cap", q.subs(f"SELECT customer_id, CAST(LEAST(monthly_charges, {100 * U}) AS DOUBLE) AS capped_charge FROM subs"))
def scalar_min_cap(spark, base):
    df = subs(spark, base, "customer_id", "monthly_charges")
    return df.select("customer_id", as_double(numbers.capped("monthly_charges", 100 * U)).alias("capped_charge"))


@register("null_handling", q.subs(
    """SELECT customer_id, CAST(COALESCE(NULLIF(total_charges, 0), monthly_charges) AS DOUBLE) AS adjusted_total, tenure
       FROM subs WHERE tenure = 0 OR total_charges IS NULL OR total_charges = 0"""))
def null_handling(spark, base):
    df = subs(spark, base, "customer_id", "monthly_charges", "total_charges", "tenure")
    empty = F.col("total_charges").isNull() | (F.col("total_charges") == 0)
    return df.filter((F.col("tenure") == 0) | empty).select(
        "customer_id", as_double(numbers.zero_to("total_charges", "monthly_charges")).alias("adjusted_total"), "tenure"
    )


@register("safe_divide", q.subs(
    "SELECT customer_id, CAST(total_charges AS DOUBLE) / NULLIF(CAST(tenure AS DOUBLE), 0) AS per_month FROM subs"))
def safe_divide(spark, base):
    df = subs(spark, base, "customer_id", "total_charges", "tenure")
    return df.select("customer_id", numbers.safe_divide("total_charges", "tenure").alias("per_month"))


@register("safe_cast",
    """SELECT o_orderkey, TRY_CAST(SUBSTR(o_orderpriority, 1, 1) AS INTEGER) AS priority,
       TRY_CAST(o_orderpriority AS INTEGER) AS whole_text, TRY_CAST(o_orderstatus AS DOUBLE) AS status_number FROM orders""")
def safe_cast(spark, base):
    orders = table(spark, base, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return orders.select(
        "o_orderkey",
        numbers.safe_cast(F.substring("o_orderpriority", 1, 1), "int").alias("priority"),
        numbers.safe_cast("o_orderpriority", "int").alias("whole_text"),
        numbers.safe_cast("o_orderstatus", "double").alias("status_number"),
    )


@register("case_searched_simple", q.subs(
    """SELECT customer_id, CASE contract WHEN 'Month-to-month' THEN 3 WHEN 'One year' THEN 1 WHEN 'Two year' THEN 0 END AS contract_points,
       CASE WHEN tenure <= 12 THEN 3 WHEN tenure <= 24 THEN 2 WHEN tenure <= 48 THEN 1 ELSE 0 END AS tenure_points FROM subs"""))
def case_searched_simple(spark, base):
    return subs(spark, base, "customer_id", "contract", "tenure").select(
        "customer_id",
        scoring.contract_points(unknown=None).alias("contract_points"),
        scoring.tenure_points().alias("tenure_points"),
    )


@register("map_values", q.subs(
    """SELECT customer_id, CASE payment_method WHEN 'Electronic check' THEN 3 WHEN 'Mailed check' THEN 2 ELSE 0 END AS points,
       CASE senior_citizen WHEN 'Yes' THEN 1 END AS senior FROM subs"""))
def map_values(spark, base):
    return subs(spark, base, "customer_id", "payment_method", "senior_citizen").select(
        "customer_id",
        ladders.map_values(F.col("payment_method"), scoring.PAYMENT_POINTS, 0).alias("points"),
        ladders.map_values(F.col("senior_citizen"), {"Yes": 1}).alias("senior"),
    )


_ACTION = q.ladder("risk_score", scoring.ACTIONS_864, scoring.ACTIONS_864_DEFAULT)


@register("select_case_default", q.subs(
    f"""SELECT customer_id, CASE WHEN churn = 0 THEN {_ACTION} ELSE '{scoring.ACTIONS_864_DEFAULT}' END AS action
        FROM (SELECT *, {q.SCORE} AS risk_score FROM subs) t"""))
def select_case_default(spark, base):
    action = scoring.action_864(F.col("risk_score"), retained=F.col("churn") == 0)
    return scored(spark, base).select("customer_id", action.alias("action"))


_CHARGE_STEPS = [(e * U, label) for e, label in zip(scoring.CHARGE_EDGES[1:], scoring.CHARGE_LABELS)]


@register("bin_right_closed", q.subs(
    f"""SELECT customer_id,
        CASE WHEN tenure BETWEEN 0 AND 72 THEN {q.ladder('tenure', list(zip(scoring.TENURE_EDGES[1:], scoring.TENURE_LABELS)), 'x', '<=')} END AS tenure_group,
        CASE WHEN monthly_charges BETWEEN 0 AND {200 * U} THEN {q.ladder('monthly_charges', _CHARGE_STEPS, 'x', '<=')} END AS charge_band FROM subs"""))
def bin_right_closed(spark, base):
    edges = [e * U for e in scoring.CHARGE_EDGES]
    return subs(spark, base, "customer_id", "tenure", "monthly_charges").select(
        "customer_id",
        ladders.bin_right_closed(F.col("tenure"), scoring.TENURE_EDGES, scoring.TENURE_LABELS).alias("tenure_group"),
        ladders.bin_right_closed(F.col("monthly_charges"), edges, scoring.CHARGE_LABELS).alias("charge_band"),
    )


@register("bin_left_closed", q.subs(
    f"SELECT customer_id, {q.ladder('monthly_charges', _CHARGE_STEPS[:3], scoring.CHARGE_LABELS[-1], '<')} AS charge_band FROM subs"))
def bin_left_closed(spark, base):
    edges = [e * U for e in scoring.CHARGE_EDGES[1:4]]
    return subs(spark, base, "customer_id", "monthly_charges").select(
        "customer_id", ladders.bin_left_closed(F.col("monthly_charges"), edges, scoring.CHARGE_LABELS).alias("charge_band")
    )


@register("weather_condition",
    f"""SELECT CASE WHEN code = 0 THEN 'Clear sky ☀️' WHEN code BETWEEN 1 AND 3 THEN 'Cloudy ⛅' WHEN code BETWEEN 51 AND 67 THEN 'Rainy 🌧️'
        WHEN code BETWEEN 80 AND 82 THEN 'Showers 🌦️' WHEN code BETWEEN 95 AND 99 THEN 'Thunderstorm ⛈️' ELSE 'Code ' || code END AS condition,
        COUNT(*) AS n, CAST(COUNT_IF(code BETWEEN 51 AND 67 OR code BETWEEN 80 AND 82) AS BIGINT) AS raining
        FROM (SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS code FROM events) e GROUP BY 1""")
def weather_condition(spark, base):
    code = F.get_json_object("props", "$.k").try_cast("int")
    events = table(spark, base, "events").select(code.alias("code"))
    return events.groupBy(scoring.weather_condition(F.col("code")).alias("condition")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(scoring.is_raining(F.col("code"))).alias("raining")
    )


@register("dim_date_generate",
    """SELECT CAST(YEAR(m)*100 + MONTH(m) AS INTEGER) AS date_key, CAST(YEAR(m) AS INTEGER) AS year, CAST(QUARTER(m) AS INTEGER) AS quarter,
       CAST(MONTH(m) AS INTEGER) AS month, STRFTIME(m, '%b') AS month_name, 1 AS is_weekday, COALESCE(n, 0) AS orders
       FROM (SELECT UNNEST(GENERATE_SERIES(DATE_TRUNC('month', MIN(o_orderdate)), DATE_TRUNC('month', MAX(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders) d
       LEFT JOIN (SELECT DATE_TRUNC('month', o_orderdate) AS om, COUNT(*) AS n FROM orders GROUP BY 1) o ON om = m""")
def dim_date_generate(spark, base):
    orders = table(spark, base, "orders").select(F.to_date("o_orderdate").alias("d"))
    months = dim_date(orders.agg(F.min("d").alias("first"), F.max("d").alias("last")))
    key = (F.year("d") * 100 + F.month("d")).alias("date_key")
    counts = orders.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return months.join(counts, "date_key", "left").select(*months.columns, F.coalesce("n", F.lit(0)).alias("orders"))


@register("partition_slug", q.subs("SELECT DISTINCT contract, LOWER(REPLACE(REPLACE(contract, '-', '_'), ' ', '_')) AS folder FROM subs"))
def partition_slug(spark, base):
    return subs(spark, base, "contract").distinct().withColumn("folder", text.partition_slug("contract"))
