"""Warehouse patterns bound to the tables.

The staging table holds the orders of the last months; the target holds the earlier ones
and, as a late load, a part of the staged ones.
"""

from pyspark.sql import functions as F

from churnlake.functions import scoring
from churnlake.functions.numbers import as_double, total
from churnlake.operators import quality
from churnlake.operators import warehouse as op
from churnlake.plans.bounded import freeze, scratch_path
from churnlake.plans.scripts import run_script
from churnlake.queries import sql as q
from churnlake.queries.registry import register
from churnlake.sinks import versions
from churnlake.sources import lookups
from churnlake.sources.subscriptions import subscriptions as subs

AT = "2026-01-01 00:00:00"
COLS = ["customer_id", "contract", "payment_method", "tenure", "monthly_charges"]
# Staged: at most two years of tenure. Already loaded: all but the first year.
STAGED, LOADED = "tenure <= 24", "tenure > 12"


def _sides(spark, base):
    df = subs(spark, base, *COLS)
    return op.staging_insert(df.filter(STAGED), AT), df.filter(LOADED)


@register("staging_insert", q.subs(f"SELECT customer_id, tenure, '{AT}' AS staged_at, 0 AS is_processed FROM subs WHERE {STAGED}"))
def staging_insert(spark, base):
    return _sides(spark, base)[0].select("customer_id", "tenure", "staged_at", "is_processed")


@register("staging_validation", q.subs(
    f"""SELECT COUNT(*) AS total, CAST(COUNT_IF(customer_id IS NULL) AS BIGINT) AS missing_id, CAST(COUNT_IF(monthly_charges <= 0) AS BIGINT) AS invalid_charge,
        CAST(COUNT_IF(contract NOT IN ('Month-to-month', 'One year', 'Two year')) AS BIGINT) AS invalid_contract,
        CAST(COUNT_IF(customer_id IN (SELECT customer_id FROM subs WHERE {LOADED})) AS BIGINT) AS duplicates FROM subs WHERE {STAGED}"""))
def staging_validation(spark, base):
    return quality.staging_validation(*_sides(spark, base), "customer_id", "monthly_charges", "contract")


_TARGET = f"target AS (SELECT * FROM subs WHERE {LOADED})"
_VALID = f"monthly_charges > {10 * q.UNIT}"


@register("insert_new_only", q.subs(
    f"""SELECT customer_id, contract, tenure FROM target UNION ALL SELECT customer_id, contract, tenure FROM subs
        WHERE {STAGED} AND {_VALID} AND customer_id NOT IN (SELECT customer_id FROM target)""", _TARGET))
def insert_new_only(spark, base):
    staging, target = _sides(spark, base)
    return op.insert_new_only(target, staging, "customer_id", F.expr(_VALID)).select("customer_id", "contract", "tenure")


@register("mark_processed", q.subs(
    f"SELECT customer_id, CASE WHEN customer_id IN (SELECT customer_id FROM target) THEN 1 ELSE 0 END AS is_processed FROM subs WHERE {STAGED}", _TARGET))
def mark_processed(spark, base):
    return op.mark_processed(*_sides(spark, base), "customer_id").select("customer_id", "is_processed")


@register("update_where", q.subs(
    f"""SELECT customer_id, CASE WHEN {STAGED} THEN tenure + 1 ELSE tenure END AS tenure,
        CAST(CASE WHEN {STAGED} THEN total_charges + monthly_charges ELSE total_charges END AS DOUBLE) AS total_charges FROM subs"""))
def update_where(spark, base):
    df = subs(spark, base, "customer_id", "tenure", "monthly_charges", "total_charges")
    changes = {"tenure": F.col("tenure") + 1, "total_charges": F.col("total_charges") + F.col("monthly_charges")}
    out = op.update_where(df, F.expr(STAGED), changes)
    return out.select("customer_id", "tenure", as_double("total_charges").alias("total_charges"))


_SCORES = f"""scores AS (SELECT customer_id, {q.SCORE} AS risk_score,
  CAST((CASE contract WHEN 'Month-to-month' THEN 430 WHEN 'One year' THEN 110 ELSE 30 END + CASE WHEN tenure <= 12 THEN 150 ELSE 0 END) AS HUGEINT) AS p2,
  CASE WHEN contract = 'Month-to-month' AND tenure <= 12 THEN 'Immediate intervention' WHEN contract = 'Month-to-month' THEN 'Email campaign' ELSE 'Standard programme' END AS action
  FROM subs WHERE churn = 0)"""


@register("upsert_by_key", q.subs(
    f"""SELECT customer_id, CASE WHEN risk_score >= 6 THEN risk_score + 1 ELSE risk_score END AS risk_score,
        CASE WHEN risk_score >= 6 THEN {q.ratio('((p2 + 1) // 2 * 11)', '10000', 3)} ELSE {q.ratio('p2', '2000', 3)} END AS churn_probability,
        CASE WHEN risk_score >= 7 THEN 'URGENT — call today' ELSE action END AS recommended_action FROM scores""", _SCORES))
def upsert_by_key(spark, base):
    scores = op.initial_scores(subs(spark, base, *COLS, "churn"))
    updates = op.refreshed_scores(scores)
    return op.upsert_by_key(scores, updates, "customer_id", ["risk_score"])


@register("delete_where", q.subs(f"SELECT customer_id, tenure FROM subs WHERE NOT COALESCE(total_charges < {20 * q.UNIT}, FALSE)"))
def delete_where(spark, base):
    df = subs(spark, base, "customer_id", "tenure", "total_charges")
    return op.delete_where(df, F.col("total_charges") < 20 * q.UNIT).select("customer_id", "tenure")


_HIT = "contract = 'Month-to-month' AND churn = 0 AND tenure <= 6"


@register("dry_run_update", q.subs(
    f"""SELECT CAST(COUNT_IF({_HIT}) AS BIGINT) AS updated, {q.avg('CASE WHEN watch THEN new END')} AS new_avg, {q.avg('CASE WHEN watch THEN monthly_charges END')} AS orig_avg
        FROM (SELECT *, contract = 'Month-to-month' AND tenure <= 6 AS watch,
              CASE WHEN {_HIT} THEN CAST({q.ratio(f"({q.cents('monthly_charges')} * 105)", '10000', 2)} AS DECIMAL(18,2)) ELSE monthly_charges END AS new FROM subs) t"""))
def dry_run_update(spark, base):
    df = subs(spark, base, "contract", "tenure", "monthly_charges", "churn")
    raised = F.round(F.col("monthly_charges") * F.lit("1.05").cast("decimal(3,2)"), 2)
    watch = F.expr("contract = 'Month-to-month' and tenure <= 6")
    return op.dry_run_update(df, F.expr(_HIT), {"monthly_charges": raised}, watch, "monthly_charges")


@register("publish_or_roll_back", q.subs(
    f"""SELECT 'published' AS state, COUNT(*) AS customers, {q.REVENUE} AS revenue FROM subs WHERE NOT (contract = 'Two year')
        UNION ALL SELECT 'rolled back', COUNT(*), {q.REVENUE} FROM subs"""))
def publish_or_roll_back(spark, base):
    """One change is staged and dropped, the next is staged and published."""
    root = scratch_path(spark, "versions")
    df = subs(spark, base, "customer_id", "contract", "monthly_charges")
    versions.publish(spark, root, versions.stage(df, root))
    versions.stage(op.update_where(versions.read_current(spark, root), F.lit(True), {"monthly_charges": F.lit(0)}), root)
    kept = versions.read_current(spark, root)
    versions.publish(spark, root, versions.stage(op.delete_where(kept, F.col("contract") == "Two year"), root))

    def state(name, frame):
        return frame.agg(F.count(F.lit(1)).alias("customers"), total("monthly_charges").alias("revenue")).select(
            F.lit(name).alias("state"), "customers", "revenue"
        )

    return state("published", versions.read_current(spark, root)).union(state("rolled back", kept))


_AFTER = f"""SELECT COUNT(*) AS customers, {q.REVENUE} AS revenue FROM (SELECT * REPLACE (CASE WHEN {STAGED} THEN monthly_charges + 1 ELSE monthly_charges END AS monthly_charges)
  FROM subs WHERE contract <> 'Two year') a"""


@register("scripted_changes", q.subs(" UNION ALL ".join(
    f"SELECT '{name}' AS script, '{state}' AS state, '{during}' AS during, a.* FROM ({_AFTER}) a"
    for name, state, during in [("update and delete", "published", "publishing"), ("failing statement", "rolled back", "writing"), ("failing check", "rolled back", "some are left")])))
def scripted_changes(spark, base):
    """A script of two changes, then one whose second statement fails on some rows, then one
    whose result fails its check: the last two leave what the first published."""
    root = scratch_path(spark, "scripted")
    versions.publish(spark, root, versions.stage(subs(spark, base, "customer_id", "contract", "tenure", "monthly_charges"), root))
    raised = f"SELECT customer_id, contract, tenure, CAST(IF({STAGED}, monthly_charges + 1, monthly_charges) AS DECIMAL(18,2)) AS monthly_charges FROM {{rows}}"
    scripts = {
        "update and delete": [raised, "SELECT * FROM {rows} WHERE NOT (contract = 'Two year')"],
        "failing statement": [raised, "SELECT customer_id, contract, CAST(CONCAT(contract, tenure) AS INT) AS tenure, monthly_charges FROM {rows}"],
        "failing check": ["SELECT * FROM {rows} WHERE monthly_charges IS NULL"],
    }
    out = None
    for name, steps in scripts.items():
        state, during = run_script(spark, root, steps, {"some are left": "SELECT COUNT(*) > 0 FROM {rows}"})
        now = versions.read_current(spark, root).agg(F.count(F.lit(1)).alias("customers"), total("monthly_charges").alias("revenue"))
        row = now.select(F.lit(name).alias("script"), F.lit(state).alias("state"), F.lit(during).alias("during"), "*")
        out = row if out is None else out.union(row)
    return out


_DIM_CUSTOMER = """dim_customer AS (SELECT ROW_NUMBER() OVER (ORDER BY customer_id) AS customer_key, customer_id, senior_citizen,
  CASE WHEN tenure <= 12 THEN '0-12 months' WHEN tenure <= 24 THEN '13-24 months' WHEN tenure <= 48 THEN '25-48 months' ELSE '49+ months' END AS tenure_group FROM subs)"""
_DIM_PLAN = """dim_plan AS (SELECT ROW_NUMBER() OVER (ORDER BY contract, internet_service, phone_service) AS plan_key, contract, internet_service, phone_service, senior_citizen
  FROM (SELECT contract, internet_service, phone_service, MIN(senior_citizen) AS senior_citizen FROM subs GROUP BY 1, 2, 3) d)"""
_DIM_PAYMENT = "dim_payment AS (SELECT ROW_NUMBER() OVER (ORDER BY payment_method) AS payment_key, * FROM payment)"
_FACT = f"""fact AS (SELECT customer_key, plan_key, payment_key, s.customer_id, s.monthly_charges, s.total_charges, s.tenure AS tenure_months, s.churn AS is_churned,
  {q.SCORE.replace('contract', 's.contract').replace('payment_method', 's.payment_method').replace('tenure', 's.tenure')} AS churn_risk_score, s.monthly_charges * s.tenure AS lifetime_value
  FROM subs s LEFT JOIN dim_customer dc ON dc.customer_id = s.customer_id
  LEFT JOIN dim_plan dp ON dp.contract = s.contract AND dp.internet_service = s.internet_service AND dp.phone_service = s.phone_service
  LEFT JOIN dim_payment dy ON dy.payment_method = s.payment_method)"""
_STAR = (q.PAYMENT, _DIM_CUSTOMER, _DIM_PLAN, _DIM_PAYMENT, _FACT)


def _customers(spark, base):
    cols = ["customer_id", "senior_citizen", "tenure_group"]
    return op.dim_build(subs(spark, base, *cols), cols, "customer_key")


def _plans(spark, base):
    unique = ["contract", "internet_service", "phone_service"]
    return op.dim_insert_ignore(subs(spark, base, *unique, "senior_citizen"), unique, ["senior_citizen"], "plan_key")


def _payments(spark, base):
    literal = lookups.from_literals(spark, lookups.PAYMENT_RISK)
    return op.dim_build(literal, literal.columns, "payment_key")


def _fact(spark, base, **dims):
    df = subs(spark, base, "customer_id", "contract", "internet_service", "phone_service", "payment_method", "monthly_charges", "total_charges", "tenure", "churn")
    return op.fact_build(df, **dims)


@register("dim_build", q.subs("SELECT * FROM dim_customer", _DIM_CUSTOMER))
def dim_build(spark, base):
    return _customers(spark, base)


@register("dim_insert_ignore", q.subs("SELECT * FROM dim_plan", _DIM_PLAN))
def dim_insert_ignore(spark, base):
    return _plans(spark, base)


_FIRST_LOAD = "1996-01-01"


@register("dim_load", q.subs(
    f"""SELECT plan_key, contract, internet_service, phone_service, senior_citizen, TRUE AS was_there FROM old
        UNION ALL SELECT (SELECT COALESCE(MAX(plan_key), 0) FROM old) + ROW_NUMBER() OVER (ORDER BY contract, internet_service, phone_service),
          contract, internet_service, phone_service, senior_citizen, FALSE FROM new""",
    f"""old AS (SELECT ROW_NUMBER() OVER (ORDER BY contract, internet_service, phone_service) AS plan_key, * FROM
          (SELECT contract, internet_service, phone_service, MIN(senior_citizen) AS senior_citizen FROM subs
           WHERE contract <> 'One year' AND start_date < '{_FIRST_LOAD}' GROUP BY 1, 2, 3) d)""",
    """new AS (SELECT contract, internet_service, phone_service, MIN(senior_citizen) AS senior_citizen FROM subs s
          WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.contract = s.contract AND o.internet_service = s.internet_service AND o.phone_service = s.phone_service)
          GROUP BY 1, 2, 3)"""))
def dim_load(spark, base):
    """A load of the plans known by a day, then one of all: the keys of the first stay."""
    unique = ["contract", "internet_service", "phone_service"]
    df = subs(spark, base, *unique, "senior_citizen", "start_date")
    early = df.filter((F.col("contract") != "One year") & (F.col("start_date") < _FIRST_LOAD))
    old = freeze(op.dim_insert_ignore(early, unique, ["senior_citizen"], "plan_key"), "dim_plan")
    both = op.dim_load(old, df, unique, ["senior_citizen"], "plan_key")
    there = old.select(F.col("plan_key").alias("_old"))
    return both.join(there, F.col("plan_key") == F.col("_old"), "left").withColumn("was_there", F.col("_old").isNotNull()).drop("_old")


@register("star_query_pruned", q.subs(
    f"""SELECT p.contract, p.internet_service, COUNT(*) AS customers, {q.money_sum('f.monthly_charges')} AS revenue, {q.pct('SUM(is_churned)', 'COUNT(*)')} AS churn_rate_pct
        FROM fact f JOIN dim_plan p ON f.plan_key = p.plan_key WHERE p.contract = 'Two year' GROUP BY 1, 2""", *_STAR))
def star_query_pruned(spark, base):
    """A filter on the plans decides at run time which folders of the fact are read."""
    path = scratch_path(spark, "fact")
    plans = freeze(_plans(spark, base), "dim_plan")
    fact = _fact(spark, base, plans=plans)
    op.store_by_key(fact.select("plan_key", "monthly_charges", "is_churned"), path, "plan_key")
    return op.star_query_pruned(spark.read.schema("monthly_charges decimal(18,2), is_churned int, plan_key bigint").parquet(path), plans, "Two year")


@register("fact_build", q.subs(
    """SELECT customer_key, plan_key, payment_key, customer_id, CAST(monthly_charges AS DOUBLE) AS monthly_charges, CAST(total_charges AS DOUBLE) AS total_charges,
       tenure_months, is_churned, churn_risk_score, CAST(lifetime_value AS DOUBLE) AS lifetime_value FROM fact""", *_STAR))
def fact_build(spark, base):
    dims = {"plans": _plans(spark, base), "payments": _payments(spark, base), "customers": _customers(spark, base)}
    fact = _fact(spark, base, **dims)
    return fact.withColumns({c: as_double(c) for c in ("monthly_charges", "total_charges", "lifetime_value")})


_STAR_RATE = q.pct("SUM(is_churned)", "COUNT(*)")
_STAR_GONE = "CAST(SUM(is_churned) AS BIGINT) AS churned"


@register("star_query_plan", q.subs(
    f"""SELECT contract, internet_service, COUNT(*) AS subscriptions, {q.AVG_MONTHLY} AS avg_monthly, {q.REVENUE} AS total_revenue, {_STAR_GONE}, {_STAR_RATE} AS churn_rate
        FROM fact JOIN dim_plan USING (plan_key) GROUP BY contract, internet_service""", *_STAR))
def star_query_plan(spark, base):
    plans = _plans(spark, base)
    return op.star_query_plan(_fact(spark, base, plans=plans), plans)


@register("star_query_payment", q.subs(
    f"""SELECT payment_category, risk_level, CAST(MIN(reliability_score) AS DOUBLE) AS reliability_score, COUNT(*) AS customers, {q.REVENUE} AS total_revenue, {_STAR_GONE}, {_STAR_RATE} AS churn_rate
        FROM fact JOIN dim_payment USING (payment_key) GROUP BY payment_category, risk_level""", *_STAR))
def star_query_payment(spark, base):
    payments = _payments(spark, base)
    return op.star_query_payment(_fact(spark, base, payments=payments), payments)


@register("star_query_customer", q.subs(
    f"""SELECT tenure_group, senior_citizen, COUNT(*) AS customers, {q.avg('lifetime_value')} AS avg_ltv, {_STAR_GONE}, {_STAR_RATE} AS churn_rate
        FROM fact JOIN dim_customer USING (customer_key) GROUP BY tenure_group, senior_citizen""", *_STAR))
def star_query_customer(spark, base):
    customers = _customers(spark, base)
    return op.star_query_customer(_fact(spark, base, customers=customers), customers)


_ACTION = q.ladder("risk_score", scoring.ACTIONS_864, scoring.ACTIONS_864_DEFAULT)
_VIEW = f"list AS (SELECT *, {_ACTION} AS action FROM (SELECT *, {q.SCORE} AS risk_score FROM subs) s WHERE churn = 0)"


def _views(spark, base):
    op.create_views(op.reporting_views(subs(spark, base)))


@register("reporting_views", q.subs(
    f"SELECT action, COUNT(*) AS customers, {q.REVENUE} AS at_risk_revenue FROM list GROUP BY action", _VIEW))
def reporting_views(spark, base):
    _views(spark, base)
    return spark.sql(
        """SELECT action, COUNT(*) AS customers, CAST(SUM(monthly_charges) AS DOUBLE) AS at_risk_revenue
           FROM vw_intervention_list GROUP BY action ORDER BY customers DESC, action"""
    )


@register("reporting_view_kpis", q.subs(
    f"""SELECT COUNT(*) AS total_customers, {q.CHURNED} AS total_churned, {q.pct('SUM(churn)', 'COUNT(*)', 2)} AS churn_rate_pct, {q.REVENUE} AS monthly_revenue FROM subs"""))
def reporting_view_kpis(spark, base):
    _views(spark, base)
    return spark.sql("SELECT total_customers, total_churned, churn_rate_pct, monthly_revenue FROM vw_executive_kpis")


@register("reporting_view_summary", q.subs(
    f"""SELECT contract, internet_service, COUNT(*) AS total, {q.RATE} AS churn_rate_pct FROM subs GROUP BY ALL
        ORDER BY churn_rate_pct DESC, contract, internet_service LIMIT 5"""))
def reporting_view_summary(spark, base):
    _views(spark, base)
    return spark.sql(
        """SELECT contract, internet_service, total, churn_rate_pct FROM vw_churn_summary
           ORDER BY churn_rate_pct DESC, contract, internet_service LIMIT 5"""
    )


@register("reporting_view_risk", q.subs(
    f"""SELECT customer_id, contract, risk_score, action FROM list WHERE monthly_charges >= {100 * q.UNIT} AND risk_score >= 7
        ORDER BY monthly_charges DESC, customer_id LIMIT 8""", _VIEW))
def reporting_view_risk(spark, base):
    _views(spark, base)
    return spark.sql(
        """SELECT customer_id, contract, risk_score, action FROM vw_intervention_list WHERE monthly_charges >= :floor AND risk_score >= 7
           ORDER BY monthly_charges DESC, customer_id LIMIT 8""", {"floor": 100 * q.UNIT}
    )


@register("reporting_view_revenue", q.subs(
    f"""SELECT * FROM (SELECT {q.ladder('tenure', scoring.LIFECYCLE_4, scoring.LIFECYCLE_4_DEFAULT, '<=')} AS lifecycle, contract, COUNT(*) AS customers,
        {q.REVENUE} AS monthly_revenue, {q.AT_RISK} AS revenue_at_risk, {q.RATE} AS churn_rate_pct FROM subs GROUP BY 1, 2) t WHERE churn_rate_pct > 27"""))
def reporting_view_revenue(spark, base):
    _views(spark, base)
    return spark.sql("SELECT * FROM vw_revenue_dashboard WHERE churn_rate_pct > 27 ORDER BY revenue_at_risk DESC")
