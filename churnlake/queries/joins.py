"""Joins bound to the tables."""

from pyspark.sql import functions as F

from churnlake.functions.numbers import as_double, mean
from churnlake.operators import joins as op
from churnlake.operators import windows
from churnlake.operators.relational import order_limit
from churnlake.queries import sql as q
from churnlake.queries.registry import register
from churnlake.sources import lookups
from churnlake.sources.subscriptions import subscriptions as subs
from churnlake.sources.tables import table


def _lookups(spark):
    tables = (lookups.CONTRACT_PRICING, lookups.INTERNET_SLA, lookups.PAYMENT_RISK)
    return [lookups.from_literals(spark, t) for t in tables]


_DISCOUNTED = q.ratio(f"({q.cents('monthly_charges')} * (100 - discount_pct))", "10000", 2)


@register("from_literals", q.subs(
    """SELECT contract_type, discount_pct, retention_bonus, risk_level, COUNT(customer_id) AS customers
       FROM pricing LEFT JOIN subs ON contract = contract_type GROUP BY ALL""", q.PRICING))
def from_literals(spark, base):
    counts = subs(spark, base, "contract").groupBy("contract").agg(F.count(F.lit(1)).alias("n"))
    terms = lookups.from_literals(spark, lookups.CONTRACT_PRICING)
    joined = terms.join(counts, F.col("contract_type") == F.col("contract"), "left")
    return joined.select(
        "contract_type", "discount_pct", "retention_bonus", "risk_level", F.coalesce("n", F.lit(0)).alias("customers")
    )


@register("inner_join_lookup", q.subs(
    f"""SELECT customer_id, contract, discount_pct, risk_level, {_DISCOUNTED} AS discounted_price
        FROM subs JOIN pricing ON contract = contract_type""", q.PRICING))
def inner_join_lookup(spark, base):
    out = op.inner_join_lookup(subs(spark, base, "customer_id", "contract", "monthly_charges"), _lookups(spark)[0])
    return out.drop("monthly_charges")


@register("inner_join_aggregate", q.subs(
    f"""SELECT contract_type, MIN(risk_level) AS risk_level, COUNT(customer_id) AS customers, {q.CHURNED} AS churned,
        {q.RATE} AS churn_rate_pct,
        {q.ratio(f"SUM({q.cents('monthly_charges')} * (100 - discount_pct))", "(10000*COUNT(*))", 2)} AS avg_discounted
        FROM subs JOIN pricing ON contract = contract_type GROUP BY contract_type""", q.PRICING))
def inner_join_aggregate(spark, base):
    return op.inner_join_aggregate(subs(spark, base, "customer_id", "contract", "monthly_charges", "churn"), _lookups(spark)[0])


@register("left_join_lookup", q.subs(
    """SELECT customer_id, internet_service, speed_mbps, support_tier, CAST(monthly_cost AS DOUBLE) AS service_base_cost
       FROM subs LEFT JOIN sla ON internet_service = service_type""", q.SLA))
def left_join_lookup(spark, base):
    return op.left_join_lookup(subs(spark, base, "customer_id", "internet_service"), _lookups(spark)[1])


@register("left_join_aggregate", q.subs(
    f"""SELECT support_tier, COUNT(customer_id) AS customers, {q.CHURNED} AS churned, {q.RATE} AS churn_rate_pct,
        {q.AVG_MONTHLY} AS avg_monthly, MIN(speed_mbps) AS speed_mbps
        FROM subs LEFT JOIN sla ON internet_service = service_type GROUP BY support_tier""", q.SLA))
def left_join_aggregate(spark, base):
    df = subs(spark, base, "customer_id", "internet_service", "monthly_charges", "churn")
    return op.left_join_aggregate(df, _lookups(spark)[1])


@register("plan_join_aggregate", q.subs(
    f"""SELECT contract, plan_type, discount_pct, churn_risk, COUNT(*) AS customers, {q.CHURNED} AS churned,
        {q.RATE} AS churn_rate_pct, {q.REVENUE} AS total_revenue
        FROM subs LEFT JOIN plans USING (contract) GROUP BY contract, plan_type, discount_pct, churn_risk""", q.PLANS))
def plan_join_aggregate(spark, base):
    plans = lookups.from_literals(spark, lookups.CONTRACT_PLANS)
    return op.plan_join_aggregate(subs(spark, base, "contract", "monthly_charges", "churn"), plans)


_MULTI = f"""multi AS (
  SELECT s.customer_id, s.churn, p.discount_pct, p.risk_level AS contract_risk, p.retention_bonus, a.speed_mbps, a.support_tier,
         r.risk_level AS payment_risk, CAST(r.reliability_score AS DOUBLE) AS reliability_score,
         {_DISCOUNTED.replace('monthly_charges', 's.monthly_charges').replace('discount_pct', 'p.discount_pct')} AS discounted_price
  FROM subs s JOIN pricing p ON s.contract = p.contract_type
  LEFT JOIN sla a ON s.internet_service = a.service_type
  LEFT JOIN payment r ON s.payment_method = r.payment_method)"""
_MULTI_CTES = (q.PRICING, q.SLA, q.PAYMENT, _MULTI)
_CORE = ["customer_id", "contract", "internet_service", "payment_method", "monthly_charges", "churn"]
_OVERALL = """CASE WHEN contract_risk = 'High' AND payment_risk = 'High' THEN 'Critical'
                   WHEN contract_risk = 'High' OR payment_risk = 'High' THEN 'Elevated' ELSE 'Low' END"""


@register("multi_join_enrich", q.subs(
    f"""SELECT customer_id, discount_pct, contract_risk, retention_bonus, speed_mbps, support_tier, payment_risk,
        reliability_score, discounted_price, {_OVERALL} AS overall_risk FROM multi""", *_MULTI_CTES))
def multi_join_enrich(spark, base):
    out = op.multi_join_enrich(subs(spark, base, *_CORE), *_lookups(spark))
    return out.drop("contract", "internet_service", "payment_method", "monthly_charges", "churn")


@register("multi_join_filter", q.subs(
    """SELECT customer_id, contract_risk, support_tier AS internet_tier, payment_risk, reliability_score
       FROM multi WHERE churn = 1 AND contract_risk = 'High' AND payment_risk = 'High'""", *_MULTI_CTES))
def multi_join_filter(spark, base):
    out = op.multi_join_filter(subs(spark, base, *_CORE), *_lookups(spark))
    return out.select(
        "customer_id", "contract_risk", F.col("support_tier").alias("internet_tier"), "payment_risk", "reliability_score"
    )


@register("lookup_risk_label", q.subs(
    f"""SELECT overall_risk, COUNT(*) AS customers, {q.CHURNED} AS churned
        FROM (SELECT *, {_OVERALL} AS overall_risk FROM multi) t GROUP BY overall_risk""", *_MULTI_CTES))
def lookup_risk_label(spark, base):
    out = op.multi_join_enrich(subs(spark, base, *_CORE), *_lookups(spark))
    return out.groupBy("overall_risk").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("churn").alias("churned")
    )


@register("risk_matrix_join", q.subs(
    f"""SELECT p.risk_level AS contract_risk, r.risk_level AS payment_risk, COUNT(*) AS customers, {q.CHURNED} AS churned,
        {q.RATE} AS churn_rate_pct
        FROM subs s JOIN pricing p ON s.contract = p.contract_type LEFT JOIN payment r ON s.payment_method = r.payment_method
        GROUP BY 1, 2""", q.PRICING, q.PAYMENT))
def risk_matrix_join(spark, base):
    pricing, _, payment = _lookups(spark)
    return op.risk_matrix_join(subs(spark, base, "contract", "payment_method", "churn"), pricing, payment)


@register("join_multi_key", q.with_(
    """SELECT l_orderkey, l_partkey, l_suppkey, p_brand, s_name, same_pair
       FROM lineitem l
       LEFT JOIN pairs ON l.l_partkey = pairs.partkey AND l.l_suppkey = pairs.suppkey
       LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey""",
    "pairs AS (SELECT l_partkey AS partkey, l_suppkey AS suppkey, COUNT(*) AS same_pair FROM lineitem GROUP BY 1, 2)"))
def join_multi_key(spark, base):
    lines = table(spark, base, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    pairs = lines.groupBy(F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey")).agg(
        F.count(F.lit(1)).alias("same_pair")
    )
    out = op.join_multi_key(lines, pairs, [("l_partkey", "partkey"), ("l_suppkey", "suppkey")])
    part = table(spark, base, "part").select("p_partkey", "p_brand")
    supplier = table(spark, base, "supplier").select("s_suppkey", "s_name")
    out = op.join_multi_key(out, part, [("l_partkey", "p_partkey")])
    out = op.join_multi_key(out, supplier, [("l_suppkey", "s_suppkey")])
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "p_brand", "s_name", "same_pair")


def _profile(prefix, flag):
    return f"""{prefix} AS (SELECT contract, COUNT(*) AS {prefix}_count, {q.avg('monthly_charges')} AS {prefix}_avg_charge,
        {q.avg('tenure', 1)} AS {prefix}_avg_tenure FROM subs WHERE churn = {flag} GROUP BY contract)"""


@register("join_cte_results", q.subs(
    "SELECT * FROM churned JOIN retained USING (contract)", _profile("churned", 1), _profile("retained", 0)))
def join_cte_results(spark, base):
    return op.join_cte_results(subs(spark, base, "contract", "monthly_charges", "tenure", "churn"))


@register("broadcast_join", q.subs(
    "SELECT customer_id, contract, plan_type, discount_pct FROM subs LEFT JOIN offers USING (contract)", q.OFFERS))
def broadcast_join(spark, base):
    offers = lookups.from_literals(spark, lookups.CONTRACT_OFFERS)
    out = op.broadcast_join(subs(spark, base, "customer_id", "contract"), offers, "contract")
    return out.select("customer_id", "contract", "plan_type", "discount_pct")


@register("broadcast_join_table", """SELECT n_name, COUNT(*) AS customers, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""")
def broadcast_join_table(spark, base):
    nation = table(spark, base, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customers = table(spark, base, "customer").select("c_nationkey", "c_acctbal")
    joined = op.broadcast_join(customers, nation, "c_nationkey")
    return joined.groupBy("n_name").agg(
        F.count(F.lit(1)).alias("customers"), as_double(F.sum(F.col("c_acctbal").cast("decimal(18,2)"))).alias("balance")
    )


@register("semi_join", q.subs(
    """SELECT customer_id, contract, internet_service FROM subs WHERE churn = 0
       AND contract IN (SELECT contract_type FROM pricing WHERE risk_level = 'High')""", q.PRICING))
def semi_join(spark, base):
    risky = _lookups(spark)[0].filter("risk_level = 'High'").select("contract_type")
    df = subs(spark, base, "customer_id", "contract", "internet_service", "churn").filter("churn = 0").drop("churn")
    return op.semi_join(df, risky, [("contract", "contract_type")])


@register("anti_join", """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (
    SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""")
def anti_join(spark, base):
    big = table(spark, base, "orders").filter("o_totalprice > 300000").select("o_custkey")
    return op.anti_join(table(spark, base, "customer").select("c_custkey", "c_name"), big, "c_custkey", "o_custkey")


@register("anti_join_null_member", """SELECT n_nationkey, n_name FROM nation WHERE n_nationkey NOT IN (
    SELECT CASE WHEN c_acctbal > 0 THEN c_nationkey END FROM customer)""")
def anti_join_null_member(spark, base):
    members = table(spark, base, "customer").select(F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).alias("k"))
    return op.anti_join(table(spark, base, "nation").select("n_nationkey", "n_name"), members, "n_nationkey", "k")


def _two_sides(spark, base):
    cust = table(spark, base, "customer").select("c_custkey", "c_name").filter("c_acctbal > 0")
    busy = (
        table(spark, base, "orders")
        .filter("o_orderstatus = 'F'")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    return cust, busy


_TWO_SIDES = """cust AS (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0),
busy AS (SELECT o_custkey, COUNT(*) AS orders FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)"""


@register("right_join", q.with_("SELECT * FROM cust RIGHT JOIN busy ON c_custkey = o_custkey", _TWO_SIDES))
def right_join(spark, base):
    return op.right_join(*_two_sides(spark, base), [("c_custkey", "o_custkey")])


@register("full_join", q.with_("SELECT * FROM cust FULL JOIN busy ON c_custkey = o_custkey", _TWO_SIDES))
def full_join(spark, base):
    return op.full_join(*_two_sides(spark, base), [("c_custkey", "o_custkey")])


@register("attach_constants", """SELECT n_nationkey, n_name, r.region_name, r.nations FROM nation, (
    SELECT MIN(r_name) AS region_name, (SELECT COUNT(*) FROM nation WHERE n_regionkey = 0) AS nations
    FROM region WHERE r_regionkey = 0) r""")
def attach_constants(spark, base):
    region = table(spark, base, "region").filter("r_regionkey = 0").select("r_name")
    nation = table(spark, base, "nation").select("n_nationkey", "n_name", "n_regionkey")
    inside = nation.filter("n_regionkey = 0").agg(F.count(F.lit(1)).alias("nations"))
    out = op.attach_constants(nation.drop("n_regionkey"), region, {"region_name": "r_name"})
    return op.attach_constants(out, inside, {"nations": "nations"})


@register("merge_reference_data", q.with_(
    """SELECT n.n_name AS name, n.n_regionkey AS region, latest.latest_order, latest.price, s.customers, s.avg_balance
       FROM nation n LEFT JOIN latest ON latest.name = n.n_name LEFT JOIN summary s ON s.name = n.n_name""",
    """latest AS (SELECT n_name AS name, o_orderkey AS latest_order, o_totalprice AS price FROM (
         SELECT n_name, o_orderkey, o_totalprice,
                ROW_NUMBER() OVER (PARTITION BY n_name ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
         FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey) t WHERE rn = 1)""",
    f"""summary AS (SELECT n_name AS name, COUNT(*) AS customers, {q.avg('CAST(c_acctbal AS DECIMAL(18,2))')} AS avg_balance
        FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name)"""))
def merge_reference_data(spark, base):
    nation = table(spark, base, "nation")
    customer = table(spark, base, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    named = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "c_acctbal")
    orders = table(spark, base, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    sold = orders.join(named, F.col("o_custkey") == F.col("c_custkey")).withColumnRenamed("n_name", "name")
    latest = windows.latest_per_key(sold, "name", ["o_orderdate", "o_orderkey"], "o_orderkey", "o_totalprice")
    latest = latest.withColumnsRenamed({"o_orderkey": "latest_order", "o_totalprice": "price"})
    summary = named.groupBy(F.col("n_name").alias("name")).agg(
        F.count(F.lit(1)).alias("customers"), mean("c_acctbal").alias("avg_balance")
    )
    profile = nation.select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    return op.merge_reference_data(profile, latest, summary)


@register("retained_by_risk", q.subs(
    f"""SELECT customer_id, tenure, contract_risk, reliability_score, overall_risk FROM (
          SELECT m.customer_id, s.tenure, s.monthly_charges, m.contract_risk, m.reliability_score, {_OVERALL} AS overall_risk
          FROM multi m JOIN subs s USING (customer_id) WHERE m.churn = 0) t
        ORDER BY monthly_charges DESC, customer_id LIMIT 8""", *_MULTI_CTES))
def retained_by_risk(spark, base):
    df = subs(spark, base, *_CORE, "tenure").filter("churn = 0")
    out = op.multi_join_enrich(df, *_lookups(spark))
    top = order_limit(out, [("monthly_charges", "desc"), ("customer_id", "asc")], 8)
    return top.select("customer_id", "tenure", "contract_risk", "reliability_score", "overall_risk")
