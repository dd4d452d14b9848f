"""Projections, predicates, sorts, subqueries and set operations on the tables."""

import uuid

from pyspark.sql import functions as F

from churnlake.functions import numbers, scoring
from churnlake.operators import relational as op
from churnlake.operators import tablefunctions
from churnlake.queries import sql as q
from churnlake.queries.registry import register
from churnlake.queries.scored import interventions
from churnlake.sources.subscriptions import subscriptions as subs

U = q.UNIT


@register("select_columns", q.subs("SELECT customer_id, tenure, CAST(monthly_charges AS DOUBLE) AS monthly_charges, contract, churn FROM subs"))
def select_columns(spark, base):
    df = subs(spark, base, "customer_id", "tenure", "monthly_charges", "contract", "churn")
    return op.select_columns(
        df.withColumn("monthly_charges", numbers.as_double("monthly_charges")),
        "customer_id", "tenure", "monthly_charges", "contract", "churn",
    )


@register("computed_column", q.subs(
    """SELECT customer_id, CAST(monthly_charges * tenure AS DOUBLE) AS estimated_lifetime_value,
              CAST(monthly_charges * 12 AS DOUBLE) AS annual_charges FROM subs"""))
def computed_column(spark, base):
    df = subs(spark, base, "customer_id", "tenure", "monthly_charges")
    df = op.computed_column(df, "estimated_lifetime_value", numbers.as_double(scoring.lifetime_value()))
    df = op.computed_column(df, "annual_charges", numbers.as_double(scoring.value_over(12)))
    return df.select("customer_id", "estimated_lifetime_value", "annual_charges")


@register("filter_eq", q.subs("SELECT customer_id, tenure, contract FROM subs WHERE contract = 'Month-to-month'"))
def filter_eq(spark, base):
    return op.filter_eq(subs(spark, base, "customer_id", "tenure", "contract"), "contract", "Month-to-month")


@register("filter_conjunction", q.subs(
    f"SELECT COUNT(*) AS high_value_churned FROM subs WHERE churn = 1 AND monthly_charges >= {90 * U}"))
def filter_conjunction(spark, base):
    df = op.filter_all(
        subs(spark, base, "monthly_charges", "churn"), F.col("churn") == 1, F.col("monthly_charges") >= 90 * U
    )
    return op.derived_table_count(df, "high_value_churned")


@register("filter_between", q.subs("SELECT customer_id, tenure FROM subs WHERE tenure BETWEEN 13 AND 24"))
def filter_between(spark, base):
    return op.filter_between(subs(spark, base, "customer_id", "tenure"), "tenure", 13, 24)


@register("filter_in_list", q.subs("SELECT customer_id, contract FROM subs WHERE contract IN ('One year', 'Two year')"))
def filter_in_list(spark, base):
    return op.filter_in_list(subs(spark, base, "customer_id", "contract"), "contract", ["One year", "Two year"])


@register("filter_like", q.subs("SELECT customer_id, payment_method FROM subs WHERE payment_method ILIKE '%AUTOMATIC%'"))
def filter_like(spark, base):
    return op.filter_like(subs(spark, base, "customer_id", "payment_method"), "payment_method", "%AUTOMATIC%")


@register("contains_flag", q.subs(
    "SELECT customer_id, CONTAINS(LOWER(payment_method), 'automatic') AS is_auto_pay FROM subs"))
def contains_flag(spark, base):
    df = subs(spark, base, "customer_id", "payment_method")
    return op.contains_flag(df, "payment_method", "Automatic", "is_auto_pay").select("customer_id", "is_auto_pay")


@register("select_distinct", q.subs("SELECT DISTINCT contract, internet_service FROM subs"))
def select_distinct(spark, base):
    return op.select_distinct(subs(spark, base, "contract", "internet_service"), "contract", "internet_service")


@register("parameterised_query", q.subs(
    f"""SELECT 'One year' AS contract_type, COUNT(*) AS total, {q.CHURNED} AS churned, {q.REVENUE} AS total_revenue
        FROM subs WHERE contract = 'One year' AND monthly_charges >= {50 * U}"""))
def parameterised_query(spark, base):
    return op.parameterised_query(
        spark,
        """SELECT :contract AS contract_type, COUNT(*) AS total, CAST(SUM(churn) AS BIGINT) AS churned,
                  CAST(SUM(monthly_charges) AS DOUBLE) AS total_revenue
           FROM {s} WHERE contract = :contract AND monthly_charges >= :threshold""",
        {"contract": "One year", "threshold": 50 * U},
        s=subs(spark, base, "contract", "monthly_charges", "churn"),
    )


_ACTION = q.ladder("risk_score", scoring.ACTIONS_864, scoring.ACTIONS_864_DEFAULT)
_INTERVENTIONS = f"""list AS (
  SELECT customer_id, contract, internet_service, CAST(monthly_charges AS DOUBLE) AS monthly_charges, risk_score, {_ACTION} AS action
  FROM (SELECT *, {q.SCORE} AS risk_score FROM subs WHERE churn = 0) s)"""


@register("risk_report", q.subs(
    f"""SELECT * FROM list WHERE monthly_charges >= {100 * U} AND risk_score >= 7
        ORDER BY risk_score DESC, monthly_charges DESC, customer_id LIMIT 10""", _INTERVENTIONS))
def risk_report(spark, base):
    out = op.risk_report(interventions(spark, base), min_monthly=100 * U, min_risk_score=7)
    return out.withColumn("monthly_charges", numbers.as_double("monthly_charges"))


_PERFORMANCE = f"""SELECT contract, internet_service, COUNT(*) AS customers, {q.RATE} AS churn_rate,
  {q.AVG_MONTHLY} AS avg_monthly, {q.REVENUE} AS total_revenue FROM subs"""


@register("segment_performance", q.subs(
    f"{_PERFORMANCE} WHERE contract = 'Month-to-month' GROUP BY contract, internet_service"))
def segment_performance(spark, base):
    df = subs(spark, base, "contract", "internet_service", "monthly_charges", "churn")
    return op.segment_performance(df, contract="Month-to-month")


@register("segment_performance_all", q.subs(f"{_PERFORMANCE} GROUP BY contract, internet_service"))
def segment_performance_all(spark, base):
    return op.segment_performance(subs(spark, base, "contract", "internet_service", "monthly_charges", "churn"))


def _named(df, prefix):
    """A temporary view of its own, so that calls in one session do not meet."""
    name = f"{prefix}_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    return name


@register("risk_report_function", q.subs(
    f"""SELECT * FROM list WHERE monthly_charges >= {100 * U} AND risk_score >= 7
        ORDER BY risk_score DESC, monthly_charges DESC, customer_id LIMIT 10""", _INTERVENTIONS))
def risk_report_function(spark, base):
    """The report called from SQL text."""
    name = _named(interventions(spark, base), "interventions")
    tablefunctions.create_risk_report(spark, f"risk_{name}", name)
    out = spark.sql(
        f"""SELECT * FROM risk_{name}(min_risk_score => :score, min_monthly => :floor)
            ORDER BY risk_score DESC, monthly_charges DESC, customer_id LIMIT 10""",
        {"score": 7, "floor": 100.0 * U},
    )
    return out.withColumn("monthly_charges", numbers.as_double("monthly_charges"))


@register("segment_performance_function", q.subs(
    f"""{_PERFORMANCE} WHERE contract = 'Month-to-month' GROUP BY contract, internet_service
        UNION ALL {_PERFORMANCE} WHERE internet_service = 'DSL' GROUP BY contract, internet_service"""))
def segment_performance_function(spark, base):
    """Two calls in one statement, each with another of the parameters."""
    name = _named(subs(spark, base, "contract", "internet_service", "monthly_charges", "churn"), "subs")
    tablefunctions.create_segment_performance(spark, f"segments_{name}", name)
    return spark.sql(
        f"""SELECT * FROM segments_{name}(only_contract => 'Month-to-month')
            UNION ALL SELECT * FROM segments_{name}(only_internet => 'DSL')"""
    )


@register("order_limit", q.subs(
    """SELECT customer_id, tenure, CAST(monthly_charges AS DOUBLE) AS monthly_charges FROM subs
       ORDER BY subs.monthly_charges DESC, customer_id LIMIT 5"""))
def order_limit(spark, base):
    df = subs(spark, base, "customer_id", "tenure", "monthly_charges")
    df = df.withColumn("monthly_charges", numbers.as_double("monthly_charges"))
    return op.order_limit(df, [("monthly_charges", "desc"), ("customer_id", "asc")], 5)


@register("order_limit_ascending", q.subs(
    "SELECT customer_id, tenure, contract FROM subs WHERE churn = 1 ORDER BY tenure, customer_id LIMIT 5"))
def order_limit_ascending(spark, base):
    df = subs(spark, base, "customer_id", "tenure", "contract", "churn").filter("churn = 1").drop("churn")
    return op.order_limit(df, [("tenure", "asc"), ("customer_id", "asc")], 5)


@register("order_multi_key", q.subs(
    "SELECT contract, customer_id, tenure FROM subs ORDER BY contract, tenure DESC, customer_id"))
def order_multi_key(spark, base):
    df = subs(spark, base, "contract", "customer_id", "tenure")
    return op.order_multi_key(df, [("contract", "asc"), ("tenure", "desc"), ("customer_id", "asc")])


@register("limit_n", q.subs("SELECT customer_id, tenure, contract FROM subs ORDER BY customer_id LIMIT 5"))
def limit_n(spark, base):
    return op.limit_n(subs(spark, base, "customer_id", "tenure", "contract"), "customer_id", 5)


@register("sample_rows", q.subs(
    """SELECT customer_id, tenure, CAST(monthly_charges AS DOUBLE) AS monthly_charges, contract, churn FROM subs
       ORDER BY md5('42:' || CAST(customer_id AS VARCHAR)), customer_id LIMIT 5"""))
def sample_rows(spark, base):
    df = subs(spark, base, "customer_id", "tenure", "monthly_charges", "contract", "churn")
    return op.sample_rows(df, "customer_id", 5, seed=42).withColumn("monthly_charges", F.col("monthly_charges").cast("double"))


_MEAN = "mean AS (SELECT SUM(CAST(monthly_charges*100 AS HUGEINT)) AS s, COUNT(*) AS n FROM subs)"


@register("scalar_subquery_select", q.subs(
    f"""SELECT customer_id, {q.ratio('(SELECT s FROM mean)', '(SELECT 100*n FROM mean)', 2)} AS avg_charge,
        {q.ratio(f"({q.cents('monthly_charges')} * (SELECT n FROM mean) - (SELECT s FROM mean))", '(SELECT 100*n FROM mean)', 2)} AS diff_from_avg
        FROM subs""", _MEAN))
def scalar_subquery_select(spark, base):
    df = subs(spark, base, "customer_id", "monthly_charges")
    return op.scalar_subquery_select(df, "monthly_charges").drop("monthly_charges")


@register("scalar_subquery_where", q.subs(
    f"""SELECT customer_id, contract FROM subs
        WHERE churn = 0 AND {q.cents('monthly_charges')} * (SELECT n FROM gone) > (SELECT s FROM gone)""",
    "gone AS (SELECT SUM(CAST(monthly_charges*100 AS HUGEINT)) AS s, COUNT(*) AS n FROM subs WHERE churn = 1)"))
def scalar_subquery_where(spark, base):
    df = subs(spark, base, "customer_id", "contract", "monthly_charges", "churn")
    gone = df.filter("churn = 1")
    return op.above_mean(df.filter("churn = 0"), "monthly_charges", gone).select("customer_id", "contract")


@register("derived_table_count", q.subs(
    f"SELECT COUNT(*) AS at_risk FROM (SELECT customer_id FROM subs WHERE churn = 0 AND contract = 'Month-to-month') t"))
def derived_table_count(spark, base):
    df = subs(spark, base, "customer_id", "contract", "churn").filter("churn = 0 and contract = 'Month-to-month'")
    return op.derived_table_count(df.select("customer_id"), "at_risk")


@register("cte_chain", q.subs(
    """SELECT customer_id, contract, CAST(monthly_charges AS DOUBLE) AS monthly_charges, tenure FROM at_risk
       ORDER BY at_risk.monthly_charges DESC, customer_id LIMIT 10""",
    f"high_value AS (SELECT * FROM subs WHERE monthly_charges > {80 * U})",
    "at_risk AS (SELECT * FROM high_value WHERE contract = 'Month-to-month' AND churn = 0)"))
def cte_chain(spark, base):
    df = subs(spark, base, "customer_id", "contract", "monthly_charges", "tenure", "churn")
    return op.cte_chain(df, 80 * U, 10).withColumn("monthly_charges", numbers.as_double("monthly_charges"))


_HIGH = f"churn = 1 AND monthly_charges >= {90 * U}"


@register("union_all_segments", q.subs(
    f"""SELECT 'High Risk Churned' AS segment, customer_id, contract, tenure FROM subs WHERE {_HIGH} AND tenure <= 12
        UNION ALL
        SELECT 'Low Risk Not Churned', customer_id, contract, tenure FROM subs
        WHERE churn = 0 AND contract = 'Two year' AND tenure >= 60"""))
def union_all_segments(spark, base):
    df = subs(spark, base, "customer_id", "contract", "tenure", "monthly_charges", "churn")
    out = op.union_all_segments(
        df,
        {
            "High Risk Churned": F.expr(f"{_HIGH} and tenure <= 12"),
            "Low Risk Not Churned": F.expr("churn = 0 and contract = 'Two year' and tenure >= 60"),
        },
    ).select("segment", "customer_id", "contract", "tenure")
    return op.order_multi_key(out, [("segment", "asc"), ("tenure", "desc"), ("customer_id", "asc")])


@register("union_all_count", q.subs(
    f"""SELECT COUNT(*) AS high_risk_churned FROM (
          SELECT customer_id FROM subs WHERE {_HIGH} UNION ALL
          SELECT customer_id FROM subs WHERE churn = 1 AND tenure <= 6) t"""))
def union_all_count(spark, base):
    df = subs(spark, base, "customer_id", "tenure", "monthly_charges", "churn")
    return op.union_all_count(df, [F.expr(_HIGH), F.expr("churn = 1 and tenure <= 6")], "high_risk_churned")


@register("concat_frames", q.subs(
    "SELECT CASE WHEN churn = 1 THEN 'Churned' ELSE 'Retained' END AS segment, customer_id, churn FROM subs"))
def concat_frames(spark, base):
    return op.concat_frames(subs(spark, base, "customer_id", "churn"), "churn", "Churned", "Retained")
