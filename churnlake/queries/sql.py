"""SQL fragments of the oracles.

DuckDB divides decimals as doubles, so ratios are rounded half up on integers here; money
is counted in cents.
"""

from __future__ import annotations

from churnlake.sources import lookups

SUBS = """
line_totals AS (
  SELECT l_orderkey,
         SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS returned,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS gross
  FROM lineitem GROUP BY l_orderkey),
subs AS (
  SELECT o.o_orderkey AS customer_id, o.o_custkey AS owner_id, CAST(o.o_orderdate AS DATE) AS start_date,
         CASE o.o_orderstatus WHEN 'F' THEN 'Month-to-month' WHEN 'O' THEN 'One year' ELSE 'Two year' END AS contract,
         CASE WHEN c.c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'Fiber optic'
              WHEN c.c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN 'DSL' ELSE 'No' END AS internet_service,
         CASE WHEN c.c_acctbal >= 7500 THEN 'Yes' ELSE 'No' END AS senior_citizen,
         CASE WHEN c.c_nationkey >= 5 THEN 'Yes' ELSE 'No' END AS phone_service,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Electronic check' WHEN '2-HIGH' THEN 'Mailed check'
              WHEN '3-MEDIUM' THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS payment_method,
         CAST((2001*12 + 8) - (YEAR(o.o_orderdate)*12 + MONTH(o.o_orderdate)) AS INTEGER) AS tenure,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS monthly_charges,
         CASE WHEN t.returned * 2 > t.gross THEN 1 ELSE 0 END AS churn,
         t.gross AS total_charges
  FROM orders o
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN line_totals t ON t.l_orderkey = o.o_orderkey)"""

# Charge thresholds of the reports, scaled to this data.
UNIT = 3900

PRICING = lookups.values_sql(lookups.CONTRACT_PRICING, "pricing")
SLA = lookups.values_sql(lookups.INTERNET_SLA, "sla")
PAYMENT = lookups.values_sql(lookups.PAYMENT_RISK, "payment")
PLANS = lookups.values_sql(lookups.CONTRACT_PLANS, "plans")
OFFERS = lookups.values_sql(lookups.CONTRACT_OFFERS, "offers")


def subs(body: str, *ctes: str) -> str:
    """Query text over the ``subs`` view with further common table expressions."""
    return "WITH " + ",\n".join([SUBS.strip(), *ctes]) + "\n" + body


def with_(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def ratio(num: str, den: str, digits: int) -> str:
    """num/den of integers rounded half away from zero."""
    s = 10**digits
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return (
        f"(CAST(SIGN({num}) * ((2*{s}*ABS({n}) + {d}) // NULLIF(2*{d}, 0)) AS DOUBLE) / {s})"
    )


def pct(part: str, whole: str, digits: int = 1) -> str:
    return ratio(f"(100*({part}))", f"({whole})", digits)


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def avg(x: str, digits: int = 2) -> str:
    """Rounded mean of a money or integer expression."""
    return ratio(f"SUM({cents(f'CAST({x} AS DECIMAL(28,2))')})", f"(100*COUNT({x}))", digits)


def money_sum(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE)"


COUNT = "COUNT(*)"
CHURNED = "CAST(SUM(churn) AS BIGINT)"
RATE = pct("SUM(churn)", "COUNT(*)", 1)
AT_RISK = "CAST(SUM(CASE WHEN churn = 1 THEN monthly_charges ELSE 0 END) AS DOUBLE)"
AVG_MONTHLY = avg("monthly_charges")
REVENUE = money_sum("monthly_charges")

SCORE_CONTRACT = "(CASE contract WHEN 'Month-to-month' THEN 3 WHEN 'One year' THEN 1 ELSE 0 END)"
SCORE_PAYMENT = "(CASE payment_method WHEN 'Electronic check' THEN 3 WHEN 'Mailed check' THEN 2 ELSE 0 END)"
SCORE_TENURE = "(CASE WHEN tenure <= 12 THEN 3 WHEN tenure <= 24 THEN 2 WHEN tenure <= 48 THEN 1 ELSE 0 END)"
SCORE = f"({SCORE_CONTRACT} + {SCORE_PAYMENT} + {SCORE_TENURE})"
SCORE_SHORT = f"({SCORE_CONTRACT} + {SCORE_TENURE})"


def ladder(value: str, steps: list[tuple[float, str]], default: str, op: str = ">=") -> str:
    """CASE over thresholds, written from the step list the operator uses."""

    def text(v) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    whens = " ".join(f"WHEN {value} {op} {edge} THEN {text(label)}" for edge, label in steps)
    return f"(CASE {whens} ELSE {text(default)} END)"
