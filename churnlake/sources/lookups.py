"""Small lookup tables held as literals.

They become local relations whose exact size the optimizer knows, so it broadcasts them
without a hint, and would not if a table of real size were passed in their place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Contract prices, service levels, payment reliability and plan names.
CONTRACT_PRICING = (
    "contract_type string, discount_pct int, retention_bonus int, risk_level string, term string",
    [
        ("Month-to-month", 0, 0, "High", "Flexible"),
        ("One year", 5, 50, "Medium", "Annual"),
        ("Two year", 15, 150, "Low", "Long-term"),
    ],
)
INTERNET_SLA = (
    "service_type string, speed_mbps int, support_tier string, monthly_cost double, sla_uptime_pct double",
    [
        ("Fiber optic", 300, "Premium", 45.0, 99.9),
        ("DSL", 50, "Standard", 25.0, 99.5),
        ("No", 0, "Basic", 0.0, 100.0),
    ],
)
PAYMENT_RISK = (
    "payment_method string, payment_category string, is_automatic int, risk_level string, reliability_score double",
    [
        ("Electronic check", "Digital", 0, "High", 6.2),
        ("Mailed check", "Paper", 0, "Medium", 7.1),
        ("Bank transfer (automatic)", "Digital", 1, "Low", 9.4),
        ("Credit card (automatic)", "Digital", 1, "Low", 9.1),
    ],
)
CONTRACT_PLANS = (
    "contract string, plan_type string, discount_pct int, churn_risk string",
    [
        ("Month-to-month", "Flexible", 0, "High"),
        ("One year", "Annual", 10, "Medium"),
        ("Two year", "Biennial", 20, "Low"),
    ],
)
CONTRACT_OFFERS = (
    "contract string, plan_type string, discount_pct int",
    [
        ("Month-to-month", "Flexible", 0),
        ("One year", "Discounted", 10),
        ("Two year", "Best Value", 20),
    ],
)


def from_literals(spark: SparkSession, lookup: tuple[str, list[tuple]]) -> DataFrame:
    """A lookup as DataFrame; it becomes a local relation in the plan."""
    fields = ", ".join(f"CAST({f.split()[0]} AS {f.split()[1]}) AS {f.split()[0]}" for f in lookup[0].split(", "))
    return spark.sql(f"WITH {values_sql(lookup, 't')} SELECT {fields} FROM t")


def values_sql(lookup: tuple[str, list[tuple]], name: str) -> str:
    """The same lookup as an SQL ``VALUES`` common table expression."""
    schema, rows = lookup

    def literal(v) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)

    columns = ", ".join(field.split()[0] for field in schema.split(", "))
    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"
