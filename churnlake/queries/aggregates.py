"""Grouped and global measures bound to the tables."""

import uuid

from pyspark.sql import functions as F

from churnlake.functions import ladders, scoring
from churnlake.operators import aggregates as op
from churnlake.plans.bounded import scratch_path
from churnlake.queries import sql as q
from churnlake.queries.registry import ORACLES, register
from churnlake.queries.scored import interventions, scored
from churnlake.sources.subscriptions import store_bucketed
from churnlake.sources.subscriptions import subscriptions as subs
from churnlake.sources.tables import table

U = q.UNIT
CONTRACTS = {"Month-to-month": "month_to_month", "One year": "one_year", "Two year": "two_year"}

_M = {
    "total": "COUNT(*) AS total",
    "customers": "COUNT(*) AS customers",
    "churned": f"{q.CHURNED} AS churned",
    "churn_rate_pct": f"{q.RATE} AS churn_rate_pct",
    "avg_monthly": f"{q.AVG_MONTHLY} AS avg_monthly",
    "avg_tenure": f"{q.avg('tenure', 1)} AS avg_tenure",
    "total_revenue": f"{q.REVENUE} AS total_revenue",
    "revenue_at_risk": f"{q.AT_RISK} AS revenue_at_risk",
}


def _grouped(keys, names, source="subs"):
    cols = ", ".join([*keys, *[_M[n] for n in names]])
    return f"SELECT {cols} FROM {source} GROUP BY {', '.join(keys)}"


def _bind(name, keys, names, count_as="total"):
    """Register one grouped report with its oracle."""

    @register(name, q.subs(_grouped(keys, names)))
    def run(spark, base):
        extra = {"avg_tenure": "tenure"}
        cols = [*keys, "monthly_charges", "churn", *[extra[n] for n in names if n in extra and extra[n] not in keys]]
        return op.churn_by(subs(spark, base, *cols), keys, names, count_as=count_as)

    return run


_TENURE_GROUP = q.ladder("tenure", list(zip(scoring.TENURE_EDGES[1:4], scoring.TENURE_LABELS)), scoring.TENURE_LABELS[-1], "<=")
_CHARGE_BAND = q.ladder(
    "monthly_charges",
    [(e * U, label) for e, label in zip(scoring.CHARGE_EDGES[1:4], scoring.CHARGE_LABELS)],
    scoring.CHARGE_LABELS[-1],
    "<",
)
_BANDS = (f"banded AS (SELECT *, {_TENURE_GROUP} AS tenure_group, {_CHARGE_BAND} AS charge_band FROM subs)",)


@register("global_kpis", q.subs(
    f"""SELECT COUNT(*) AS total_customers, {q.CHURNED} AS total_churned, {q.AVG_MONTHLY} AS avg_monthly_charge,
        {q.avg('tenure', 1)} AS avg_tenure_months, CAST(MIN(monthly_charges) AS DOUBLE) AS min_charge,
        CAST(MAX(monthly_charges) AS DOUBLE) AS max_charge, {q.REVENUE} AS total_monthly_revenue FROM subs"""))
def global_kpis(spark, base):
    return op.global_kpis(subs(spark, base, "monthly_charges", "tenure", "churn"))


_KPI = f"""COUNT(*) AS total_customers, {q.CHURNED} AS total_churned, {q.pct('SUM(churn)', 'COUNT(*)', 2)} AS churn_rate_pct,
  {q.AVG_MONTHLY} AS avg_monthly_charge, {q.AT_RISK} AS revenue_at_risk, {q.avg('tenure', 1)} AS avg_tenure_months"""


@register("executive_summary", q.subs(
    f"""SELECT {_KPI}, {q.REVENUE} AS total_monthly_revenue, {q.money_sum('monthly_charges * 12')} AS annual_revenue,
        {q.avg('CASE WHEN churn = 0 THEN tenure END', 1)} AS avg_retained_tenure,
        {q.avg('CASE WHEN churn = 1 THEN tenure END', 1)} AS avg_churned_tenure FROM subs"""))
def executive_summary(spark, base):
    return op.executive_summary(subs(spark, base, "monthly_charges", "tenure", "churn"))


@register("executive_kpis", q.subs(
    f"""SELECT {_KPI}, {q.REVENUE} AS monthly_revenue,
        {q.avg('CASE WHEN churn = 0 THEN monthly_charges * tenure END', 2)} AS avg_retained_clv FROM subs"""))
def executive_kpis(spark, base):
    return op.executive_kpis(subs(spark, base, "monthly_charges", "tenure", "churn"))


_bind("churn_by_contract", ["contract"], ["total", "churned", "churn_rate_pct", "avg_monthly", "avg_tenure", "total_revenue"])
_bind("churn_by_service", ["internet_service"], ["total", "churned", "churn_rate_pct", "avg_monthly", "total_revenue", "avg_tenure"])
_bind("churn_by_payment", ["payment_method"], ["total", "churned", "churn_rate_pct", "avg_monthly"])
_bind("churn_by_senior", ["contract", "senior_citizen"], ["total", "churned", "churn_rate_pct", "avg_monthly"])
_bind(
    "segment_summary",
    ["contract", "internet_service"],
    ["customers", "churned", "churn_rate_pct", "avg_monthly", "total_revenue", "revenue_at_risk"],
    count_as="customers",
)


@register("churn_by_contract_stored", ORACLES["churn_by_contract"])
def churn_by_contract_stored(spark, base):
    """The report over orders and line totals that are stored in buckets of the order key."""
    name = f"subs_{uuid.uuid4().hex}"
    store_bucketed(spark, base, name, scratch_path(spark, "buckets"), 8)
    names = ["total", "churned", "churn_rate_pct", "avg_monthly", "avg_tenure", "total_revenue"]
    return op.churn_by(subs(spark, base, "contract", "tenure", "monthly_charges", "churn", stored=name), ["contract"], names)


@register("churn_by_tenure_group", q.subs(_grouped(["tenure_group"], ["total", "churned", "churn_rate_pct", "avg_monthly", "total_revenue"], "banded"), *_BANDS))
def churn_by_tenure_group(spark, base):
    df = subs(spark, base, "tenure_group", "monthly_charges", "churn")
    names = ["total", "churned", "churn_rate_pct", "avg_monthly", "total_revenue"]
    return op.in_band_order(df.groupBy("tenure_group").agg(*op.measures(*names)), "tenure_group", scoring.TENURE_LABELS)


@register("churn_by_charge_band", q.subs(_grouped(["charge_band"], ["total", "churned", "churn_rate_pct", "avg_tenure"], "banded"), *_BANDS))
def churn_by_charge_band(spark, base):
    df = subs(spark, base, "charge_band", "tenure", "churn")
    names = ["total", "churned", "churn_rate_pct", "avg_tenure"]
    return op.in_band_order(df.groupBy("charge_band").agg(*op.measures(*names)), "charge_band", scoring.CHARGE_LABELS)


@register("segment_having", q.subs(
    f"""SELECT * FROM (SELECT contract, internet_service, COUNT(*) AS total, {q.RATE} AS churn_rate_pct
        FROM subs GROUP BY contract, internet_service) t WHERE churn_rate_pct > 25"""))
def segment_having(spark, base):
    return op.segment_having(subs(spark, base, "contract", "internet_service", "churn"), ["contract", "internet_service"], 25)


@register("segment_three_keys", q.subs(
    _grouped(["contract", "internet_service", "tenure_group"], ["total", "churned", "churn_rate_pct", "avg_monthly"], "banded"), *_BANDS))
def segment_three_keys(spark, base):
    keys = ["contract", "internet_service", "tenure_group"]
    df = subs(spark, base, *keys, "monthly_charges", "churn")
    return op.churn_by(df, keys, ["total", "churned", "churn_rate_pct", "avg_monthly"])


_LABEL = q.ladder("risk_score", scoring.LABELS_753, "Low")
_SCORED = (
    f"scored0 AS (SELECT *, {q.SCORE} AS risk_score FROM subs)",
    f"scored AS (SELECT *, {_LABEL} AS risk_label, monthly_charges * tenure AS lifetime_value FROM scored0)",
)


@register("segment_by_risk_label", q.subs(
    _grouped(["contract", "internet_service", "risk_label"], ["customers", "churned", "churn_rate_pct", "total_revenue", "revenue_at_risk"], "scored"), *_SCORED))
def segment_by_risk_label(spark, base):
    keys = ["contract", "internet_service", "risk_label"]
    names = ["customers", "churned", "churn_rate_pct", "total_revenue", "revenue_at_risk"]
    return op.churn_by(scored(spark, base), keys, names, count_as="customers")


_SEGMENT_LABEL = q.ladder("churn_rate_pct", scoring.SEGMENT_LABELS, scoring.SEGMENT_LABELS_DEFAULT)


@register("segment_risk_label", q.subs(
    f"""SELECT *, {_SEGMENT_LABEL} AS risk_label FROM (
        {_grouped(["contract", "internet_service"], ["customers", "churned", "churn_rate_pct", "total_revenue", "revenue_at_risk"])}) t"""))
def segment_risk_label(spark, base):
    return op.segment_risk_matrix(subs(spark, base, "contract", "internet_service", "monthly_charges", "churn"))


@register("churned_vs_retained", q.subs(
    f"""SELECT CASE WHEN churn = 1 THEN 'Churned' ELSE 'Retained' END AS status, COUNT(*) AS customers,
        {q.REVENUE} AS monthly_revenue, {q.AVG_MONTHLY} AS avg_monthly, {q.money_sum('total_charges')} AS lifetime_revenue
        FROM subs GROUP BY churn"""))
def churned_vs_retained(spark, base):
    return op.churned_vs_retained(subs(spark, base, "monthly_charges", "total_charges", "churn"))


_STAGE_LONG = q.ladder("tenure", scoring.LIFECYCLE_5_LONG, scoring.LIFECYCLE_5_LONG_DEFAULT, "<=")
_STAGE_4 = q.ladder("tenure", scoring.LIFECYCLE_4, scoring.LIFECYCLE_4_DEFAULT, "<=")
_STAGE_NAMES = ["customers", "churned", "churn_rate_pct", "avg_monthly", "total_revenue"]


@register("group_by_expression", q.subs(
    f"SELECT {_STAGE_LONG} AS lifecycle_stage, {', '.join(_M[n] for n in _STAGE_NAMES)} FROM subs GROUP BY 1"))
def group_by_expression(spark, base):
    df = subs(spark, base, "tenure", "monthly_charges", "churn")
    return op.group_by_expression(df, "lifecycle_stage", scoring.lifecycle_5(long_names=True), _STAGE_NAMES)


@register("lifecycle_4", q.subs(
    f"""SELECT {_STAGE_4} AS lifecycle, contract, {_M['customers']}, {_M['total_revenue']}, {_M['revenue_at_risk']}, {_M['churn_rate_pct']}
        FROM subs GROUP BY 1, 2"""))
def lifecycle_4(spark, base):
    df = subs(spark, base, "tenure", "contract", "monthly_charges", "churn").withColumn("lifecycle", scoring.lifecycle_4())
    return op.churn_by(df, ["lifecycle", "contract"], ["customers", "total_revenue", "revenue_at_risk", "churn_rate_pct"], "customers")


@register("conditional_count", q.subs(
    """SELECT contract, COUNT(*) AS total, CAST(COUNT_IF(churn = 1) AS BIGINT) AS churned,
       CAST(COUNT_IF(churn = 0) AS BIGINT) AS retained FROM subs GROUP BY contract"""))
def conditional_count(spark, base):
    return op.conditional_count(subs(spark, base, "contract", "churn"), "contract")


@register("stddev_min_max", q.subs(
    f"""SELECT contract, COUNT(*) AS total, {q.AVG_MONTHLY} AS avg_value, CAST(MAX(monthly_charges) AS DOUBLE) AS max_value,
        CAST(MIN(monthly_charges) AS DOUBLE) AS min_value, ROUND(STDDEV(CAST(monthly_charges AS DOUBLE)), 2) AS stddev_value
        FROM subs GROUP BY contract"""))
def stddev_min_max(spark, base):
    return op.stddev_min_max(subs(spark, base, "contract", "monthly_charges"), "contract", "monthly_charges")


@register("pivot_counts", q.subs(
    "SELECT internet_service, "
    + ", ".join(f"CAST(COUNT_IF(contract = '{v}') AS BIGINT) AS {n}" for v, n in CONTRACTS.items())
    + ", COUNT(*) AS total FROM subs GROUP BY internet_service"))
def pivot_counts(spark, base):
    return op.pivot_counts(subs(spark, base, "internet_service", "contract"), "internet_service", "contract", CONTRACTS)


@register("pivot_rates", q.subs(
    "SELECT internet_service, "
    + ", ".join(
        q.pct(f"COUNT_IF(contract = '{v}' AND churn = 1)", f"COUNT_IF(contract = '{v}')") + f" AS {n}_pct"
        for v, n in CONTRACTS.items()
    )
    + " FROM subs GROUP BY internet_service"))
def pivot_rates(spark, base):
    df = subs(spark, base, "internet_service", "contract", "churn")
    return op.pivot_rates(df, "internet_service", "contract", {v: f"{n}_pct" for v, n in CONTRACTS.items()})


@register("pivot_value", q.subs(
    "SELECT payment_method, "
    + ", ".join(f"COALESCE(MAX(CASE WHEN contract = '{v}' THEN churn_rate_pct END), 0) AS {n}" for v, n in CONTRACTS.items())
    + f" FROM (SELECT payment_method, contract, {q.RATE} AS churn_rate_pct FROM subs GROUP BY 1, 2) t GROUP BY payment_method"))
def pivot_value(spark, base):
    df = subs(spark, base, "payment_method", "contract", "churn")
    rates = df.groupBy("payment_method", "contract").agg(*op.measures("churn_rate_pct"))
    return op.pivot_value(rates, "payment_method", "contract", "churn_rate_pct", CONTRACTS)


def _counts_sql(column, source):
    return f"SELECT {column}, n, {q.pct('n', f'(SELECT COUNT(*) FROM {source})')} AS pct FROM (SELECT {column}, COUNT(*) AS n FROM {source} GROUP BY {column}) t"


@register("value_counts", _counts_sql("event_type", "events"))
def value_counts(spark, base):
    return op.value_counts(table(spark, base, "events").select("event_type"), "event_type")


@register("value_counts_payment", q.subs(_counts_sql("payment_method", "subs")))
def value_counts_payment(spark, base):
    return op.value_counts(subs(spark, base, "payment_method"), "payment_method")


def _describe_sql(c):
    d = f"CAST({c} AS DOUBLE)"
    return f"""SELECT '{c}' AS "column", COUNT({c}) AS count, {q.avg(c)} AS mean, ROUND(STDDEV({d}), 2) AS std, MIN({d}) AS min,
      ROUND(QUANTILE_CONT({d}, 0.25), 4) AS p25, ROUND(QUANTILE_CONT({d}, 0.5), 4) AS p50, ROUND(QUANTILE_CONT({d}, 0.75), 4) AS p75,
      MAX({d}) AS max FROM subs"""


@register("describe_numeric", q.subs(" UNION ALL ".join(_describe_sql(c) for c in ("tenure", "monthly_charges", "total_charges"))))
def describe_numeric(spark, base):
    columns = ["tenure", "monthly_charges", "total_charges"]
    return op.describe_numeric(subs(spark, base, *columns), columns)


_PROFILED = {"customer_id": "bigint", "contract": "string", "tenure": "int", "monthly_charges": "decimal(18,2)", "total_charges": "decimal(20,2)", "churn": "int"}


@register("profile_columns", q.subs(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS type, COUNT({c}) AS non_null, COUNT(*) - COUNT({c}) AS nulls FROM subs""" for c, t in _PROFILED.items())))
def profile_columns(spark, base):
    return op.profile_columns(subs(spark, base, *_PROFILED))


_CORR = {"tenure": "tenure", "monthly_charges": "monthly_charges", "total_charges": "total_charges", "churn": "churn", "senior": "CASE WHEN senior_citizen = 'Yes' THEN 1 ELSE 0 END"}


def _corr_sql(a, b):
    x, y = (f"CAST({_CORR[c]} AS DOUBLE)" for c in (a, b))
    value = "MAX(CAST(1 AS DOUBLE))" if a == b else f"ROUND(CORR({x}, {y}), 2)"
    return f"""SELECT '{a}' AS "row", '{b}' AS col, {value} AS corr FROM subs"""


@register("correlation_matrix", q.subs(" UNION ALL ".join(_corr_sql(a, b) for a in _CORR for b in _CORR)))
def correlation_matrix(spark, base):
    df = subs(spark, base, "tenure", "monthly_charges", "total_charges", "churn", "senior_citizen")
    df = df.withColumn("senior", ladders.map_values(F.col("senior_citizen"), {"Yes": 1, "No": 0}))
    return op.correlation_matrix(df, list(_CORR))


@register("histogram", q.subs(
    """SELECT churn, CAST(LEAST(FLOOR((v - lo) / ((hi - lo) / 25)) + 1, 25) AS INTEGER) AS bin, COUNT(*) AS n
       FROM (SELECT churn, CAST(monthly_charges AS DOUBLE) AS v FROM subs) s
       JOIN (SELECT churn, MIN(CAST(monthly_charges AS DOUBLE)) AS lo, MAX(CAST(monthly_charges AS DOUBLE)) AS hi FROM subs GROUP BY churn) b
       USING (churn) GROUP BY 1, 2"""))
def histogram(spark, base):
    return op.histogram(subs(spark, base, "monthly_charges", "churn"), "monthly_charges", 25, "churn")


_FACTORS = {"Contract": "contract", "Internet": "internet_service", "Tenure": "tenure_group"}


@register("risk_factor_table", q.subs(
    f"""SELECT factor, {q.RATE} AS churn_rate_pct, COUNT(*) AS customers FROM (
        {" UNION ALL ".join(f"SELECT '{n}: ' || {c} AS factor, churn FROM banded" for n, c in _FACTORS.items())}) t
        GROUP BY factor ORDER BY churn_rate_pct DESC, factor LIMIT 8""", *_BANDS))
def risk_factor_table(spark, base):
    return op.risk_factor_table(subs(spark, base, *_FACTORS.values(), "churn"), _FACTORS)


@register("revenue_loss_share", q.subs(
    f"""SELECT {q.REVENUE} AS total_revenue, {q.AT_RISK} AS lost_revenue,
        CAST(SUM(CASE WHEN churn = 0 THEN monthly_charges ELSE 0 END) AS DOUBLE) AS retained_revenue,
        {q.ratio(f"(100*SUM({q.cents('CASE WHEN churn = 1 THEN monthly_charges END')}))", f"SUM({q.cents('monthly_charges')})", 1)} AS loss_pct
        FROM subs"""))
def revenue_loss_share(spark, base):
    return op.revenue_loss_share(subs(spark, base, "monthly_charges", "churn"))


@register("arg_extreme", q.subs(
    """SELECT (SELECT contract FROM r ORDER BY rate DESC, contract LIMIT 1) AS highest,
              (SELECT contract FROM r ORDER BY rate, contract LIMIT 1) AS lowest""",
    f"r AS (SELECT contract, {q.RATE} AS rate FROM subs GROUP BY contract)"))
def arg_extreme(spark, base):
    rates = op.churn_by(subs(spark, base, "contract", "churn"), ["contract"], ["churn_rate_pct"])
    return op.arg_extreme(rates, "contract", "churn_rate_pct")


_ACTION = q.ladder("risk_score", scoring.ACTIONS_864, scoring.ACTIONS_864_DEFAULT)


@register("action_summary", q.subs(
    f"""SELECT {_ACTION} AS action, COUNT(*) AS customers, {q.REVENUE} AS monthly_at_risk,
        {q.money_sum('monthly_charges * 12')} AS annual_at_risk, {q.AVG_MONTHLY} AS avg_monthly, {q.avg('risk_score', 1)} AS avg_risk
        FROM scored WHERE churn = 0 GROUP BY 1""", *_SCORED))
def action_summary(spark, base):
    return op.action_summary(interventions(spark, base))


@register("risk_label_summary", q.subs(
    f"""SELECT risk_label, {_M['customers']}, {_M['churned']}, {_M['churn_rate_pct']}, {_M['avg_monthly']},
        {q.money_sum('lifetime_value')} AS total_ltv FROM scored GROUP BY risk_label""", *_SCORED))
def risk_label_summary(spark, base):
    return op.risk_label_summary(scored(spark, base))


@register("word_top_counts", q.with_(
    "SELECT word, COUNT(*) AS n FROM w WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT 10",
    r"w AS (SELECT UNNEST(REGEXP_SPLIT_TO_ARRAY(text, '\s+')) AS word FROM documents)"))
def word_top_counts(spark, base):
    return op.top_counts(op.words(table(spark, base, "documents"), "text"), "word", 10)


@register("frequent_words", q.with_(
    "SELECT word, n FROM (SELECT word, COUNT(*) AS n FROM w WHERE word <> '' GROUP BY word) t WHERE n > 500 ORDER BY n DESC, word LIMIT 10",
    r"w AS (SELECT UNNEST(REGEXP_SPLIT_TO_ARRAY(text, '\s+')) AS word FROM documents)"))
def frequent_words(spark, base):
    return op.top_counts(op.words(table(spark, base, "documents"), "text"), "word", 10, min_count=500)


@register("bin_open_low", q.subs(
    f"""SELECT tenure_band, COUNT(*) AS customers, {q.RATE} AS churn_pct FROM (
        SELECT churn, CASE WHEN tenure > 0 AND tenure <= 72 THEN {q.ladder('tenure', list(zip(scoring.YEAR_EDGES[1:], scoring.YEAR_LABELS)), 'x', '<=')} END AS tenure_band FROM subs) t
        WHERE tenure_band IS NOT NULL GROUP BY tenure_band"""))
def bin_open_low(spark, base):
    return op.bin_open_low(subs(spark, base, "tenure", "churn"))
