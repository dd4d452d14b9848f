"""Rankings and running figures bound to the tables."""

from pyspark.sql import functions as F

from churnlake.functions import scoring
from churnlake.functions.numbers import as_double
from churnlake.operators import windows as op
from churnlake.queries import sql as q
from churnlake.queries.registry import register
from churnlake.queries.scored import scored
from churnlake.sources.subscriptions import subscriptions as subs
from churnlake.sources.tables import table

CHARGE_DESC = [("monthly_charges", "desc")]


def _plain(df):
    return df.withColumn("monthly_charges", as_double("monthly_charges"))


@register("row_number_global", q.subs(
    """SELECT customer_id, CAST(monthly_charges AS DOUBLE) AS monthly_charges,
              ROW_NUMBER() OVER (ORDER BY subs.monthly_charges DESC, customer_id) AS rank_overall FROM subs"""))
def row_number_global(spark, base):
    return op.row_number_global(_plain(subs(spark, base, "customer_id", "monthly_charges")), CHARGE_DESC, ["customer_id"])


@register("top_n_per_group", q.subs(
    """SELECT * FROM (SELECT contract, customer_id, tenure,
         ROW_NUMBER() OVER (PARTITION BY contract ORDER BY monthly_charges DESC, customer_id) AS rank_in_contract FROM subs) t
       WHERE rank_in_contract <= 3"""))
def top_n_per_group(spark, base):
    df = subs(spark, base, "contract", "customer_id", "tenure", "monthly_charges")
    out = op.top_n_per_group(df, "contract", [*CHARGE_DESC, ("customer_id", "asc")], 3, "rank_in_contract")
    return out.drop("monthly_charges").withColumn("rank_in_contract", F.col("rank_in_contract").cast("bigint"))


@register("rank_vs_dense",
    """SELECT event_id, event_type, RANK() OVER (ORDER BY ROUND(value) DESC) AS rank_with_gaps,
       DENSE_RANK() OVER (ORDER BY ROUND(value) DESC) AS dense_rank_no_gaps FROM events""")
def rank_vs_dense(spark, base):
    events = table(spark, base, "events").select("event_id", "event_type", F.floor(F.col("value") + 0.5).alias("value"))
    return op.rank_vs_dense(events, [("value", "desc")], ["event_id"]).drop("value")


_TOP_RANK = """SELECT * FROM (SELECT contract, customer_id, {more}
    RANK() OVER (PARTITION BY contract ORDER BY {by} DESC) AS {name} FROM {source}) t WHERE {name} <= 3"""


@register("rank_top_with_ties", q.subs(_TOP_RANK.format(more="tenure,", by="tenure", name="tenure_rank", source="subs")))
def rank_top_with_ties(spark, base):
    df = subs(spark, base, "contract", "customer_id", "tenure")
    out = op.rank_top_with_ties(df, "contract", [("tenure", "desc")], 3, "tenure_rank")
    return out.withColumn("tenure_rank", F.col("tenure_rank").cast("bigint"))


@register("rank_top_retained", q.subs(
    _TOP_RANK.format(more="tenure,", by="monthly_charges", name="spend_rank", source="(SELECT * FROM subs WHERE churn = 0) s")))
def rank_top_retained(spark, base):
    df = subs(spark, base, "contract", "customer_id", "tenure", "monthly_charges", "churn").filter("churn = 0").drop("churn")
    out = op.rank_top_with_ties(df, "contract", CHARGE_DESC, 3, "spend_rank").drop("monthly_charges")
    return out.withColumn("spend_rank", F.col("spend_rank").cast("bigint"))


@register("rank_and_dense_per_group", q.subs(
    """SELECT contract, customer_id, spend_rank, spend_dense_rank FROM (SELECT contract, customer_id,
         RANK() OVER (PARTITION BY contract ORDER BY tenure DESC) AS spend_rank,
         DENSE_RANK() OVER (PARTITION BY contract ORDER BY tenure DESC) AS spend_dense_rank FROM subs) t WHERE spend_rank <= 100"""))
def rank_and_dense_per_group(spark, base):
    df = subs(spark, base, "contract", "customer_id", "tenure")
    out = op.rank_and_dense_top(df, "contract", [("tenure", "desc")], 100).drop("tenure")
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("spend_rank", "spend_dense_rank")})


_SCORED = (
    f"scored0 AS (SELECT *, {q.SCORE} AS risk_score FROM subs)",
    f"scored AS (SELECT *, {q.ladder('risk_score', scoring.LABELS_753, 'Low')} AS risk_label, monthly_charges * tenure AS lifetime_value FROM scored0)",
)


@register("rank_top_lifetime", q.subs(
    _TOP_RANK.format(more="risk_label, CAST(lifetime_value AS DOUBLE) AS lifetime_value,", by="scored.lifetime_value", name="ltv_rank", source="scored"), *_SCORED))
def rank_top_lifetime(spark, base):
    out = op.rank_top_with_ties(scored(spark, base), "contract", [("lifetime_value", "desc")], 3, "ltv_rank")
    return out.select(
        "contract", "customer_id", "risk_label", as_double("lifetime_value").alias("lifetime_value"), F.col("ltv_rank").cast("bigint").alias("ltv_rank")
    )


@register("rank_then_filter", q.subs(
    """SELECT customer_id, contract, tenure, risk_score, rank_in_segment FROM (
         SELECT *, RANK() OVER (PARTITION BY risk_label ORDER BY monthly_charges DESC) AS rank_in_segment FROM scored) t
       WHERE risk_label = 'Critical' AND churn = 0 AND rank_in_segment <= 10""", *_SCORED))
def rank_then_filter(spark, base):
    keep = (F.col("risk_label") == "Critical") & (F.col("churn") == 0)
    out = op.rank_then_filter(scored(spark, base), "risk_label", CHARGE_DESC, 10, keep, "rank_in_segment")
    return out.select("customer_id", "contract", "tenure", "risk_score", F.col("rank_in_segment").cast("bigint").alias("rank_in_segment"))


_REV = "rev AS (SELECT contract, SUM(monthly_charges) AS r, COUNT(*) AS customers FROM subs GROUP BY contract)"
_SHARE = q.ratio(f"(100*{q.cents('r')})", f"(SELECT SUM({q.cents('r')}) FROM rev)", 1)


@register("running_total", q.subs(
    f"""SELECT contract, customers, CAST(r AS DOUBLE) AS monthly_rev, CAST(SUM(r) OVER (ORDER BY r DESC) AS DOUBLE) AS running_total,
        {_SHARE} AS pct_of_total FROM rev""", _REV))
def running_total(spark, base):
    return op.running_total(subs(spark, base, "contract", "monthly_charges"), "contract")


@register("share_of_total", q.subs(f"SELECT contract, CAST(r AS DOUBLE) AS value, {_SHARE} AS pct_of_total FROM rev", _REV))
def share_of_total(spark, base):
    return op.share_of_total(subs(spark, base, "contract", "monthly_charges"), "contract", "monthly_charges")


@register("vs_partition_avg", q.subs(
    f"""SELECT customer_id, contract, CAST(monthly_charges AS DOUBLE) AS monthly_charges, avg_in_contract,
        (SELECT {q.AVG_MONTHLY} FROM subs) AS overall_avg,
        CAST(t.monthly_charges - CAST(avg_in_contract AS DECIMAL(18,2)) AS DOUBLE) AS vs_contract_avg, churn
        FROM (SELECT s.*, a.avg_in_contract FROM subs s JOIN a USING (contract)) t
        WHERE churn = 1 AND t.monthly_charges > CAST(avg_in_contract AS DECIMAL(18,2))""",
    f"a AS (SELECT contract, {q.AVG_MONTHLY} AS avg_in_contract FROM subs GROUP BY contract)"))
def vs_partition_avg(spark, base):
    return op.vs_partition_avg(subs(spark, base, "customer_id", "contract", "monthly_charges", "churn"))


@register("ntile_quartiles", q.subs(
    f"""SELECT charge_quartile, COUNT(*) AS customers, CAST(MIN(monthly_charges) AS DOUBLE) AS min_charge,
        CAST(MAX(monthly_charges) AS DOUBLE) AS max_charge, {q.AVG_MONTHLY} AS avg_charge, {q.CHURNED} AS churned, {q.RATE} AS churn_rate_pct
        FROM (SELECT *, CAST(NTILE(4) OVER (ORDER BY monthly_charges, customer_id) AS INTEGER) AS charge_quartile FROM subs) t GROUP BY charge_quartile"""))
def ntile_quartiles(spark, base):
    return op.ntile_quartiles(subs(spark, base, "customer_id", "monthly_charges", "churn"), "customer_id")


_TIER5 = " ".join(f"WHEN {k} THEN '{v}'" for k, v in op.CLV_TIERS.items())
_TIER4 = " ".join(f"WHEN {k} THEN '{v}'" for k, v in op.QUARTILE_TIERS.items())


@register("clv_tiers", q.subs(
    f"""SELECT clv_quintile, CASE clv_quintile {_TIER5} END AS tier, COUNT(*) AS customers, CAST(MIN(v) AS DOUBLE) AS min_clv,
        CAST(MAX(v) AS DOUBLE) AS max_clv, {q.avg('v')} AS avg_clv, {q.CHURNED} AS churned, {q.RATE} AS churn_rate_pct, {q.AT_RISK} AS clv_at_risk
        FROM (SELECT *, monthly_charges * tenure AS v,
              CAST(NTILE(5) OVER (ORDER BY monthly_charges * tenure, customer_id) AS INTEGER) AS clv_quintile FROM subs) t GROUP BY clv_quintile"""))
def clv_tiers(spark, base):
    return op.clv_tiers(subs(spark, base, "customer_id", "monthly_charges", "tenure", "churn"), "customer_id")


@register("cumulative_rate", q.subs(
    f"""SELECT tenure, customers, churned, {q.pct('churned', 'customers')} AS churn_rate_pct, cumulative_customers, cumulative_churned,
        {q.pct('cumulative_churned', 'cumulative_customers')} AS cumulative_churn_rate FROM (
          SELECT *, CAST(SUM(customers) OVER (ORDER BY tenure) AS BIGINT) AS cumulative_customers,
                 CAST(SUM(churned) OVER (ORDER BY tenure) AS BIGINT) AS cumulative_churned
          FROM (SELECT tenure, COUNT(*) AS customers, {q.CHURNED} AS churned FROM subs GROUP BY tenure) m WHERE tenure <= 24) t"""))
def cumulative_rate(spark, base):
    return op.cumulative_rate(subs(spark, base, "tenure", "churn"), 24)


_TENTHS = "CAST((2000*churned + customers) // (2*customers) AS BIGINT)"


@register("moving_average", q.subs(
    f"""SELECT tenure, customers, churned, CAST(tenths AS DOUBLE) / 10 AS churn_rate, avg_charge,
        CAST(SUM(customers) OVER (ORDER BY tenure) AS BIGINT) AS cumulative_customers,
        CAST((2*SUM(tenths) OVER w + COUNT(*) OVER w) // (2*COUNT(*) OVER w) AS DOUBLE) / 10 AS moving_avg_churn
        FROM (SELECT *, {_TENTHS} AS tenths FROM (
          SELECT tenure, COUNT(*) AS customers, {q.CHURNED} AS churned, {q.AVG_MONTHLY} AS avg_charge FROM subs WHERE tenure <= 36 GROUP BY tenure) m) t
        WINDOW w AS (ORDER BY tenure ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""))
def moving_average(spark, base):
    return op.moving_average(subs(spark, base, "tenure", "monthly_charges", "churn"), 36)


_RANKED = f"""ranked AS (
  SELECT s.customer_id, s.contract, s.churn, s.monthly_charges, RANK() OVER (ORDER BY s.monthly_charges DESC) AS revenue_rank,
         CAST(NTILE(4) OVER (ORDER BY s.monthly_charges, s.customer_id) AS INTEGER) AS charge_quartile,
         a.avg AS contract_avg_charge,
         {q.ratio(f"({q.cents('s.monthly_charges')} * a.n - a.t)", "(100*a.n)", 2)} AS vs_contract_avg
  FROM subs s JOIN (SELECT contract, COUNT(*) AS n, SUM({q.cents('monthly_charges')}) AS t, {q.AVG_MONTHLY} AS avg FROM subs GROUP BY contract) a
  ON a.contract = s.contract),
tiers AS (SELECT *, CASE charge_quartile {_TIER4} END AS customer_tier FROM ranked)"""


def _ranked(spark, base):
    return op.ranked_customers(subs(spark, base, "customer_id", "contract", "monthly_charges", "churn"), "customer_id")


@register("ranked_customers", q.subs(
    "SELECT customer_id, contract, revenue_rank, charge_quartile, contract_avg_charge, vs_contract_avg, customer_tier FROM tiers", _RANKED))
def ranked_customers(spark, base):
    return _ranked(spark, base).drop("churn", "monthly_charges")


@register("ranked_customers_tiers", q.subs(
    f"""SELECT customer_tier, COUNT(*) AS customers, {q.CHURNED} AS churned, {q.AVG_MONTHLY} AS avg_charge, {q.RATE} AS churn_rate_pct
        FROM tiers GROUP BY customer_tier""", _RANKED))
def ranked_customers_tiers(spark, base):
    return op.tier_summary(_ranked(spark, base))


_STAGE = q.ladder("tenure", scoring.LIFECYCLE_5, scoring.LIFECYCLE_5_DEFAULT, "<=")


@register("lifecycle_report", q.subs(
    f"""SELECT *, CAST(SUM(customers) OVER (ORDER BY stage) AS BIGINT) AS cumulative_customers FROM (
        SELECT {_STAGE} AS stage, COUNT(*) AS customers, {q.CHURNED} AS churned, {q.RATE} AS churn_pct, {q.REVENUE} AS total_revenue,
        {q.AT_RISK} AS revenue_at_risk,
        {q.ratio(f"(100*SUM({q.cents('CASE WHEN churn = 1 THEN monthly_charges ELSE 0 END')}))", f"SUM({q.cents('monthly_charges')})", 1)} AS risk_pct
        FROM subs GROUP BY 1) t"""))
def lifecycle_report(spark, base):
    return op.lifecycle_report(subs(spark, base, "tenure", "monthly_charges", "churn"), scoring.lifecycle_5())


@register("latest_per_key",
    """SELECT user_id, event_id, event_type, value FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) t WHERE rn = 1""")
def latest_per_key(spark, base):
    events = table(spark, base, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return op.latest_per_key(events, "user_id", ["ts", "event_id"], "event_id", "event_type", "value")
