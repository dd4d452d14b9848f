"""The ``subscriptions`` view: one row per order, shaped like a customer churn table.

Three tables feed it. ``orders`` gives the row, ``customer`` the household facts and
``lineitem`` the returns that decide the churn flag. A query names the columns it needs
and only the joins behind those columns are planned: a report on contracts never reads
``customer`` and a report on charges alone never aggregates ``lineitem``. Both joins are
left joins on the other side's key, so leaving one out changes no row.

No side is broadcast by hint: at scale all three grow, and adaptive execution picks a
broadcast from the measured size or splits a skewed partition. ``lineitem`` is aggregated
to its order key first, with map-side partial sums, so one huge order costs one row per
task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.functions.scoring import charge_band, tenure_group
from churnlake.sources.tables import table

# Month the tenure is counted back from: August 2001.
REFERENCE_MONTH = 2001 * 12 + 8

# The charges of this data are about 3,900 times a monthly phone bill.
CHARGE_UNIT = 3900

# Columns by the table that holds their facts.
FROM_ORDERS = {
    "customer_id": "o_orderkey",
    "owner_id": "o_custkey",
    "start_date": "to_date(o_orderdate)",
    "contract": "CASE o_orderstatus WHEN 'F' THEN 'Month-to-month' WHEN 'O' THEN 'One year' ELSE 'Two year' END",
    "payment_method": """CASE o_orderpriority WHEN '1-URGENT' THEN 'Electronic check' WHEN '2-HIGH' THEN 'Mailed check'
        WHEN '3-MEDIUM' THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END""",
    "tenure": f"CAST({REFERENCE_MONTH} - (year(o_orderdate) * 12 + month(o_orderdate)) AS INT)",
    "monthly_charges": "CAST(o_totalprice AS DECIMAL(18,2))",
}
FROM_CUSTOMER = {
    "internet_service": """CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'Fiber optic'
        WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN 'DSL' ELSE 'No' END""",
    "senior_citizen": "CASE WHEN c_acctbal >= 7500 THEN 'Yes' ELSE 'No' END",
    "phone_service": "CASE WHEN c_nationkey >= 5 THEN 'Yes' ELSE 'No' END",
}
FROM_LINES = {
    "churn": "CASE WHEN returned_cents * 2 > gross_cents THEN 1 ELSE 0 END",
    "total_charges": "CAST(CAST(gross_cents AS DECIMAL(20,0)) / 100 AS DECIMAL(20,2))",
}
# Bands, and the column each is cut from.
DERIVED = {"tenure_group": "tenure", "charge_band": "monthly_charges"}

ALL_COLUMNS = [
    "customer_id",
    "owner_id",
    "contract",
    "internet_service",
    "payment_method",
    "tenure",
    "monthly_charges",
    "churn",
]


def line_totals(lineitem: DataFrame) -> DataFrame:
    """Gross and returned value per order in whole cents.

    Prices carry two decimals, so cents are exact, and a sum of longs stays in the compact
    aggregation buffer where a wide decimal would not.
    """
    cents = "CAST(rint(l_extendedprice * 100) AS BIGINT)"
    return lineitem.groupBy("l_orderkey").agg(
        F.expr(f"sum(CASE WHEN l_returnflag = 'R' THEN {cents} ELSE 0L END) AS returned_cents"),
        F.expr(f"sum({cents}) AS gross_cents"),
    )


def _columns(source: dict[str, str], needed: set[str]) -> list[str]:
    return [f"{value} AS {name}" for name, value in source.items() if name in needed]


def store_bucketed(spark: SparkSession, base: str, name: str, path: str, buckets: int) -> None:
    """Orders, and the line totals of each order, as tables ``name_orders`` and ``name_lines``:
    bucketed and sorted by the order key, one file a bucket.

    The view over them (``subscriptions(stored=name)``) joins bucket with bucket: neither the
    lines nor the orders are shuffled again by any report. ``buckets`` should make a bucket
    fit into a task.
    """

    def keep(df: DataFrame, key: str, kind: str) -> None:
        writer = df.repartition(buckets, key).write.mode("overwrite").option("path", f"{path}/{kind}")
        writer.bucketBy(buckets, key).sortBy(key).saveAsTable(f"{name}_{kind}")

    keep(table(spark, base, "orders"), "o_orderkey", "orders")
    keep(line_totals(table(spark, base, "lineitem")), "l_orderkey", "lines")


def subscriptions(spark: SparkSession, base: str, *columns: str, stored: str | None = None) -> DataFrame:
    """The view with the named columns; the eight core columns when none are named. With
    ``stored``, orders and line totals come from the tables of ``store_bucketed``."""
    wanted = list(columns) or ALL_COLUMNS
    needed = set(wanted) | {DERIVED[c] for c in wanted if c in DERIVED}
    with_lines, with_household = (bool(needed & s.keys()) for s in (FROM_LINES, FROM_CUSTOMER))
    keys = {"customer_id"} if with_lines else set()
    keys |= {"owner_id"} if with_household else set()

    orders = spark.table(f"{stored}_orders") if stored else table(spark, base, "orders")
    df = orders.selectExpr(*_columns(FROM_ORDERS, needed | keys))
    added = []
    if with_household:
        facts = [c for c in ("c_mktsegment", "c_acctbal", "c_nationkey") if any(c in FROM_CUSTOMER.get(n, "") for n in needed)]
        side = table(spark, base, "customer").select("c_custkey", *facts)
        df = df.join(side, F.expr("owner_id = c_custkey"), "left")
        added += _columns(FROM_CUSTOMER, needed)
    if with_lines:
        lines = spark.table(f"{stored}_lines") if stored else line_totals(table(spark, base, "lineitem"))
        df = df.join(lines, F.expr("customer_id = l_orderkey"), "left")
        added += _columns(FROM_LINES, needed)
    if added:
        df = df.selectExpr(*[c for c in FROM_ORDERS if c in needed], *added)
    if "tenure_group" in needed:
        df = df.withColumn("tenure_group", tenure_group())
    if "charge_band" in needed:
        df = df.withColumn("charge_band", charge_band(F.col("monthly_charges"), CHARGE_UNIT))
    return df.select(*wanted)
