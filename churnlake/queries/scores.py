"""Risk scores, labels and actions bound to the subscriptions."""

from pyspark.sql import functions as F

from churnlake.functions import scoring
from churnlake.functions.numbers import as_double, churn_rate, churned_count, mean, total
from churnlake.operators import aggregates
from churnlake.operators.relational import order_limit
from churnlake.queries import sql as q
from churnlake.queries.registry import register
from churnlake.queries.scored import scored
from churnlake.sources import lookups
from churnlake.sources.subscriptions import subscriptions as subs
from churnlake.sources.tables import table

KEYS = ["customer_id", "contract", "payment_method", "tenure"]
_RECOVERY = f"({q.SCORE_CONTRACT} + {q.SCORE_PAYMENT} + CASE WHEN tenure <= 12 THEN 3 WHEN tenure <= 24 THEN 2 ELSE 0 END)"
_NULLABLE = f"(CASE contract WHEN 'Month-to-month' THEN 3 WHEN 'One year' THEN 1 WHEN 'Two year' THEN 0 END + {q.SCORE_PAYMENT} + {q.SCORE_TENURE})"
_L753 = q.ladder("risk_score", scoring.LABELS_753, "Low")
_L742 = q.ladder("total_risk_score", scoring.LABELS_742, scoring.LABELS_742_DEFAULT)
_L531 = q.ladder("risk_score", scoring.LABELS_531, "Low")


def _scores(name, expression, score):
    @register(name, q.subs(f"SELECT customer_id, {expression} AS risk_score FROM subs"))
    def run(spark, base):
        return subs(spark, base, *KEYS).select("customer_id", score().alias("risk_score"))

    return run


_scores("risk_score_full", q.SCORE, scoring.risk_score_full)
_scores("risk_score_short", q.SCORE_SHORT, scoring.risk_score_short)


@register("risk_score_recovery", q.subs(
    f"""SELECT COUNT(*) AS at_risk_customers, {q.REVENUE} AS monthly_revenue_at_risk, {q.AVG_MONTHLY} AS avg_monthly_charge,
        {q.money_sum('monthly_charges * 12')} AS annual_revenue_at_risk FROM subs WHERE churn = 0 AND {_RECOVERY} >= 6"""))
def risk_score_recovery(spark, base):
    df = subs(spark, base, *KEYS, "monthly_charges", "churn")
    return aggregates.recovery_summary(df.filter((F.col("churn") == 0) & (scoring.risk_score_recovery() >= 6)))


def _some_contracts_unknown(df):
    """Contracts of customers without a service count as not known."""
    return df.withColumn("contract", F.when(F.col("internet_service") != "No", F.col("contract")))


_UNKNOWN = "s AS (SELECT * REPLACE (CASE WHEN internet_service <> 'No' THEN contract END AS contract) FROM subs)"


@register("risk_score_null_contract", q.subs(
    f"""SELECT {_L742} AS risk_band, COUNT(*) AS customers, {q.CHURNED} AS actual_churned, {q.RATE} AS churn_rate_pct, {q.AVG_MONTHLY} AS avg_monthly,
        {q.avg('total_risk_score', 1)} AS avg_risk_score FROM (SELECT *, {_NULLABLE} AS total_risk_score FROM s) t GROUP BY 1""", _UNKNOWN))
def risk_score_null_contract(spark, base):
    df = _some_contracts_unknown(subs(spark, base, *KEYS, "internet_service", "monthly_charges", "churn"))
    df = df.withColumn("total_risk_score", scoring.risk_score_null_contract())
    return aggregates.risk_band_summary(df.withColumn("risk_band", scoring.risk_label_742(F.col("total_risk_score"))))


@register("risk_label_753", q.subs(
    f"SELECT risk_label, COUNT(*) AS customers, {q.AVG_MONTHLY} AS avg_monthly FROM (SELECT *, {_L753} AS risk_label FROM (SELECT *, {q.SCORE} AS risk_score FROM subs) t) u GROUP BY 1"))
def risk_label_753(spark, base):
    return scored(spark, base).groupBy("risk_label").agg(*aggregates.measures("customers", "avg_monthly", count_as="customers"))


@register("risk_label_742", q.subs(
    f"""SELECT {_L742} AS risk_band, COUNT(*) AS customers, {q.CHURNED} AS actual_churned, {q.RATE} AS churn_rate_pct, {q.AVG_MONTHLY} AS avg_monthly,
        {q.avg('total_risk_score', 1)} AS avg_risk_score FROM (SELECT *, {q.SCORE} AS total_risk_score FROM subs) t GROUP BY 1"""))
def risk_label_742(spark, base):
    df = subs(spark, base, *KEYS, "monthly_charges", "churn").withColumn("total_risk_score", scoring.risk_score_full())
    return aggregates.risk_band_summary(df.withColumn("risk_band", scoring.risk_label_742(F.col("total_risk_score"))))


@register("risk_label_531", q.subs(
    f"""SELECT risk_label, COUNT(*) AS customers, {q.CHURNED} AS churned, {q.RATE} AS churn_rate_pct, {q.AVG_MONTHLY} AS avg_monthly
        FROM (SELECT *, {_L531} AS risk_label FROM (SELECT *, {q.SCORE_SHORT} AS risk_score FROM subs) t) u GROUP BY 1"""))
def risk_label_531(spark, base):
    df = subs(spark, base, *KEYS, "monthly_charges", "churn")
    df = df.withColumn("risk_label", scoring.risk_label_531(scoring.risk_score_short()))
    return aggregates.churn_by(df, ["risk_label"], ["customers", "churned", "churn_rate_pct", "avg_monthly"], "customers")


@register("risk_level_view", q.subs(
    """SELECT customer_id, CASE WHEN contract = 'Month-to-month' AND payment_method = 'Electronic check' AND tenure <= 12 THEN 'Critical'
       WHEN contract = 'Month-to-month' THEN 'High' ELSE 'Low' END AS risk_level FROM subs"""))
def risk_level_view(spark, base):
    return subs(spark, base, *KEYS).select("customer_id", scoring.risk_level_view().alias("risk_level"))


_A864 = q.ladder("risk_score", scoring.ACTIONS_864, scoring.ACTIONS_864_DEFAULT)


@register("action_864", q.subs(
    f"SELECT customer_id, risk_score, {_A864} AS action FROM (SELECT *, {q.SCORE} AS risk_score FROM subs WHERE churn = 0) t"))
def action_864(spark, base):
    df = scored(spark, base).filter("churn = 0")
    return df.select("customer_id", "risk_score", scoring.action_864(F.col("risk_score")).alias("action"))


@register("action_753", q.subs(
    f"""SELECT customer_id, risk_score, CAST(monthly_charges * tenure AS DOUBLE) AS current_clv, CAST(monthly_charges * 24 AS DOUBLE) AS potential_2yr_value,
        {q.ladder('risk_score', scoring.ACTIONS_753, scoring.ACTIONS_753_DEFAULT)} AS recommended_action
        FROM (SELECT *, {q.SCORE} AS risk_score FROM subs WHERE churn = 0) t WHERE risk_score >= 6 ORDER BY monthly_charges DESC, customer_id LIMIT 15"""))
def action_753(spark, base):
    df = scored(spark, base).filter("churn = 0 and risk_score >= 6")
    top = order_limit(df, [("monthly_charges", "desc"), ("customer_id", "asc")], 15)
    return top.select(
        "customer_id",
        "risk_score",
        as_double("lifetime_value").alias("current_clv"),
        as_double(scoring.value_over(24)).alias("potential_2yr_value"),
        scoring.action_753(F.col("risk_score")).alias("recommended_action"),
    )


_P = "CASE contract WHEN 'Month-to-month' THEN 430 WHEN 'One year' THEN 110 ELSE 30 END + CASE WHEN tenure <= 12 THEN 150 ELSE 0 END"


@register("action_scored", q.subs(
    f"""SELECT customer_id, {q.SCORE} AS risk_score, {q.ratio(f'({_P})', '2000', 3)} AS churn_probability,
        CASE WHEN contract = 'Month-to-month' AND tenure <= 12 THEN 'Immediate intervention' WHEN contract = 'Month-to-month' THEN 'Email campaign'
        ELSE 'Standard programme' END AS recommended_action FROM subs WHERE churn = 0"""))
def action_scored(spark, base):
    return subs(spark, base, *KEYS, "churn").filter("churn = 0").select(
        "customer_id",
        scoring.risk_score_full().alias("risk_score"),
        scoring.churn_probability().alias("churn_probability"),
        scoring.action_scored().alias("recommended_action"),
    )


@register("action_priority_rate", q.subs(
    f"""SELECT *, CASE WHEN churn_rate_pct > 40 THEN 'Immediate' WHEN churn_rate_pct > 20 THEN 'High' ELSE 'Standard' END AS intervention_priority FROM (
        SELECT internet_service AS service_type, COUNT(*) AS customers, {q.CHURNED} AS churned, {q.pct('SUM(churn)', 'COUNT(*)', 2)} AS churn_rate_pct,
        {q.money_sum('monthly_charges * 12')} AS annual_revenue_projection FROM subs GROUP BY 1) t"""))
def action_priority_rate(spark, base):
    df = subs(spark, base, "internet_service", "monthly_charges", "churn")
    out = df.groupBy(F.col("internet_service").alias("service_type")).agg(
        F.count(F.lit(1)).alias("customers"),
        churned_count().alias("churned"),
        churn_rate(digits=2).alias("churn_rate_pct"),
        total(F.col("monthly_charges") * 12).alias("annual_revenue_projection"),
    )
    return out.withColumn("intervention_priority", scoring.action_priority_rate(F.col("churn_rate_pct")))


@register("lifecycle_5", q.subs(f"SELECT customer_id, {q.ladder('tenure', scoring.LIFECYCLE_5, scoring.LIFECYCLE_5_DEFAULT, '<=')} AS stage FROM subs"))
def lifecycle_5(spark, base):
    return subs(spark, base, "customer_id", "tenure").select("customer_id", scoring.lifecycle_5().alias("stage"))


@register("value_columns", q.subs(
    """SELECT customer_id, CAST(monthly_charges * tenure AS DOUBLE) AS lifetime_value, CAST(monthly_charges * 12 AS DOUBLE) AS annual_value,
       CAST(monthly_charges * 24 AS DOUBLE) AS two_year_value FROM subs"""))
def value_columns(spark, base):
    df = subs(spark, base, "customer_id", "monthly_charges", "tenure")
    return df.select("customer_id", *[as_double(v).alias(n) for n, v in scoring.value_columns().items()])


@register("discounted_price", q.subs(
    f"""SELECT contract, {q.avg('CAST(price AS DECIMAL(18,2))')} AS avg_price, {q.money_sum('CAST(price AS DECIMAL(18,2))')} AS total_price FROM (
        SELECT contract, {q.ratio(f"({q.cents('monthly_charges')} * (100 - discount_pct))", "10000", 2)} AS price FROM subs JOIN plans USING (contract)) t GROUP BY contract""", q.PLANS))
def discounted_price(spark, base):
    plans = lookups.from_literals(spark, lookups.CONTRACT_PLANS).select("contract", "discount_pct")
    df = subs(spark, base, "contract", "monthly_charges").join(plans, "contract")
    priced = df.withColumn("price", scoring.discounted_price())
    return priced.groupBy("contract").agg(mean("price").alias("avg_price"), total("price").alias("total_price"))


@register("classify_amount",
    f"""SELECT size, satisfaction, band, COUNT(*) AS n FROM (SELECT {q.ladder('o_totalprice / 5', scoring.PROJECT_SIZES, scoring.PROJECT_SIZE_DEFAULT)} AS size,
        {q.ladder('o_totalprice / 100000', scoring.SATISFACTION, scoring.SATISFACTION_DEFAULT)} AS satisfaction,
        {q.ladder('o_totalprice / 40', scoring.SALARY_BANDS, scoring.SALARY_BAND_DEFAULT)} AS band FROM orders) t GROUP BY ALL""")
def classify_amount(spark, base):
    price = F.col("o_totalprice")
    return (
        table(spark, base, "orders")
        .groupBy(
            scoring.at_least(price / 5, scoring.PROJECT_SIZES, scoring.PROJECT_SIZE_DEFAULT).alias("size"),
            scoring.at_least(price / 100000, scoring.SATISFACTION, scoring.SATISFACTION_DEFAULT).alias("satisfaction"),
            scoring.at_least(price / 40, scoring.SALARY_BANDS, scoring.SALARY_BAND_DEFAULT).alias("band"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
