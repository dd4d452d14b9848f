"""Streaming and whole runs bound to the tables."""

from pyspark.sql import functions as F

from churnlake.functions.numbers import percent
from churnlake.operators import quality
from churnlake.plans import runs as op
from churnlake.plans.bounded import scratch_path
from churnlake.queries import sql as q
from churnlake.queries.quality import _HR, _hr, _projects
from churnlake.queries.registry import register
from churnlake.sinks.files import write_csv
from churnlake.sources.files import read_csv_schema
from churnlake.sources.subscriptions import subscriptions as subs
from churnlake.sources.tables import table
from churnlake.streaming import arrivals

AT = "2026-01-01 00:00:00"


def _drop_files(spark, base, root, contracts):
    """Files of each contract in a folder of its own; one folder has another column order."""
    df = subs(spark, base, "customer_id", "contract", "monthly_charges", "churn").select(
        F.when(F.col("monthly_charges") >= 10 * q.UNIT, F.col("customer_id").cast("string")).alias("customerID"),
        F.col("contract").alias("Contract"),
        F.col("monthly_charges").cast("string").alias("MonthlyCharges"),
        F.when(F.col("churn") == 1, "Yes").otherwise("0").alias("Churn"),
    )
    for contract in contracts:
        part = df.filter(F.col("Contract") == contract)
        order = ["Churn", "customerID", "Contract", "MonthlyCharges"] if contract == "One year" else part.columns
        write_csv(part.select(*order), f"{root}/{contract.split()[0]}")


_FILES = f"""SELECT contract, CAST(COUNT(*) AS BIGINT) AS total_records, CAST(COUNT_IF(monthly_charges >= {10 * q.UNIT}) AS BIGINT) AS valid,
  {q.CHURNED} AS churned, {q.RATE} AS churn_rate_pct, 'SUCCESS' AS status FROM (SELECT * REPLACE (SPLIT_PART(contract, ' ', 1) AS contract) FROM subs) s GROUP BY contract"""


def _per_folder(results):
    folder = F.element_at(F.split("source_file", "/"), -2)
    sums = results.groupBy(folder.alias("contract")).agg(
        *[F.sum(c).alias(c) for c in ("total_records", "valid", "churned")], F.max("status").alias("status")
    )
    return sums.withColumn("churn_rate_pct", percent(F.col("churned"), F.col("total_records")))


def _run_stream(spark, root):
    query = arrivals.stream_incoming_files(
        spark, f"{root}/incoming", f"{root}/processed", f"{root}/results", f"{root}/checkpoint", AT
    )
    query.awaitTermination()


@register("per_file_results", q.subs(_FILES))
def per_file_results(spark, base):
    """Two drops, a run after each: the second run takes only the new files."""
    root = scratch_path(spark, "arrivals")
    _drop_files(spark, base, f"{root}/incoming", ["Month-to-month", "One year"])
    _run_stream(spark, root)
    _drop_files(spark, base, f"{root}/incoming", ["Two year"])
    _run_stream(spark, root)
    return _per_folder(arrivals.read_results(spark, f"{root}/results"))


@register("stream_incoming_files", q.subs(
    f"""SELECT CASE WHEN monthly_charges >= {10 * q.UNIT} THEN CAST(customer_id AS VARCHAR) END AS "customerID", contract AS "Contract",
        CAST(monthly_charges AS VARCHAR) AS "MonthlyCharges", CASE WHEN churn = 1 THEN 'Yes' ELSE '0' END AS "Churn", '{AT}' AS auto_processed_at FROM subs"""))
def stream_incoming_files(spark, base):
    root = scratch_path(spark, "arrivals")
    _drop_files(spark, base, f"{root}/incoming", ["Month-to-month", "One year", "Two year"])
    _run_stream(spark, root)
    return arrivals.read_processed(spark, f"{root}/processed").drop("source")


def _deliver(spark, base, root, contract, told):
    """The files of a contract under fixed names, with or without its churn flags; a second
    delivery replaces the first one's files."""
    df = subs(spark, base, "customer_id", "contract", "monthly_charges", "churn").filter(F.col("contract") == contract)
    flag = F.when((F.col("churn") == 1) & F.lit(told), "Yes").otherwise("0")
    files = df.select(
        F.col("customer_id").cast("string").alias("customerID"), "contract",
        F.col("monthly_charges").cast("string").alias("MonthlyCharges"), flag.alias("Churn"),
    )
    # Equal keys give equal parts, whose numbers name the files of either delivery.
    staged = f"{root}-staged/{contract.split()[0]}-{told}"
    write_csv(files.repartition(16, "customerID"), staged)
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(context._jsc.hadoopConfiguration())
    folder = path(f"{root}/{contract.split()[0]}")
    fs.mkdirs(folder)
    for found in fs.listStatus(path(staged)):
        name = found.getPath().getName()
        if name.endswith(".csv"):
            to = path(folder, name[: len("part-00000")] + ".csv")
            fs.delete(to, False)
            fs.rename(found.getPath(), to)


@register("redelivered_files", q.subs(
    f"""SELECT contract, CAST(COUNT(*) AS BIGINT) AS total_records, {q.CHURNED} AS churned,
        CAST(CASE contract WHEN 'Month-to-month' THEN 2 ELSE 1 END AS BIGINT) AS deliveries FROM subs GROUP BY contract"""))
def redelivered_files(spark, base):
    """All files, first without churn flags for one contract, then those again with them, then
    a run with nothing new."""
    root = scratch_path(spark, "deliveries")
    incoming, ledger = f"{root}/incoming", f"{root}/ledger"
    run = lambda: arrivals.process_deliveries(spark, incoming, f"{root}/processed", f"{root}/results", ledger, AT)
    for contract in ("Month-to-month", "One year", "Two year"):
        _deliver(spark, base, incoming, contract, contract != "Month-to-month")
    run()
    _deliver(spark, base, incoming, "Month-to-month", True)
    run()
    run()
    rows = arrivals.read_latest(spark, f"{root}/processed", ledger)
    folder = lambda c: F.element_at(F.split(c, "/"), -2)
    often = arrivals.read_ledger(spark, ledger).groupBy("path").count().groupBy(folder("path").alias("folder")).agg(F.max("count").alias("deliveries"))
    sums = rows.groupBy("contract").agg(F.count(F.lit(1)).alias("total_records"), F.count_if(F.col("Churn") == "Yes").alias("churned"))
    return sums.join(often, F.split("contract", " ")[0] == F.col("folder")).select("contract", "total_records", "churned", "deliveries")


@register("on_demand_file_scan", q.subs(
    f"""SELECT COUNT(*) AS total_customers, CAST(COUNT_IF(churn = 1) AS BIGINT) AS churned, {q.pct('SUM(churn)', 'COUNT(*)', 2)} AS churn_rate_pct,
        CAST(COUNT_IF(contract = 'Month-to-month' AND churn = 0) AS BIGINT) AS high_risk_retained FROM subs"""))
def on_demand_file_scan(spark, base):
    root = scratch_path(spark, "scan")
    _drop_files(spark, base, root, ["Month-to-month", "One year", "Two year"])
    return quality.churn_file_summary(arrivals.on_demand_file_scan(spark, root))


@register("staged_run", q.subs(
    f"""SELECT 'SUCCESS' AS status, COUNT(*) AS total_customers, {q.CHURNED} AS total_churned, {q.pct('SUM(churn)', 'COUNT(*)', 2)} AS churn_rate_pct,
        {q.REVENUE} AS monthly_revenue, {q.AT_RISK} AS revenue_at_risk FROM subs"""))
def staged_run(spark, base):
    out = scratch_path(spark, "run")
    report = op.churn_run(spark, lambda: subs(spark, base), out, AT)
    stored = spark.read.schema(
        "total_customers bigint, total_churned bigint, churn_rate_pct double, monthly_revenue double, revenue_at_risk double"
    ).json(f"{out}/report")
    return stored.select(F.lit(report.status).alias("status"), "*")


@register("multi_source_ingest",
    """SELECT 'orders' AS source, 'SUCCESS' AS status, COUNT(*) AS rows, NULL::VARCHAR AS message FROM orders UNION ALL
       SELECT 'events', 'SUCCESS', COUNT(*), NULL FROM events UNION ALL SELECT 'missing', 'WARNING', NULL, 'PATH_NOT_FOUND'""")
def multi_source_ingest(spark, base):
    gone = scratch_path(spark, "missing")
    _, report = op.multi_source_ingest(
        spark,
        {
            "orders": lambda: table(spark, base, "orders"),
            "missing": lambda: read_csv_schema(spark, gone, "a string"),
            "events": lambda: table(spark, base, "events"),
        },
        scratch_path(spark, "landing"),
    )
    return report


_TENURE = "CASE WHEN tenure <= 12 THEN '0-12 months' WHEN tenure <= 24 THEN '13-24 months' WHEN tenure <= 48 THEN '25-48 months' ELSE '49+ months' END"


def _map_sql(key):
    return f"(SELECT STRING_AGG(k || '=' || r, ';' ORDER BY k) FROM (SELECT {key} AS k, {q.RATE} AS r FROM subs GROUP BY 1) m)"


@register("insight_report", q.subs(
    f"""SELECT COUNT(*) AS total_customers, CAST(COUNT_IF(churn = 1) AS BIGINT) AS churned_customers, CAST(COUNT_IF(churn = 0) AS BIGINT) AS retained_customers,
        {q.pct('SUM(churn)', 'COUNT(*)', 2)} AS churn_rate_pct, {q.AT_RISK} AS monthly_revenue_at_risk,
        {q.avg('CASE WHEN churn = 1 THEN monthly_charges END')} AS avg_monthly_charge_churned, {q.avg('CASE WHEN churn = 0 THEN monthly_charges END')} AS avg_monthly_charge_retained,
        {_map_sql('contract')} AS churn_by_contract, {_map_sql(_TENURE)} AS churn_by_tenure, {_map_sql('internet_service')} AS churn_by_internet, {_map_sql('payment_method')} AS churn_by_payment,
        (SELECT contract FROM (SELECT contract, {q.RATE} AS r FROM subs GROUP BY 1) m ORDER BY r DESC, contract LIMIT 1) AS top_risk_factor,
        (SELECT contract FROM (SELECT contract, {q.RATE} AS r FROM subs GROUP BY 1) m ORDER BY r, contract LIMIT 1) AS safest_contract FROM subs"""))
def insight_report(spark, base):
    out = op.insights(subs(spark, base, *op.INSIGHT_GROUPS.values(), "monthly_charges", "churn"))

    def text(name):
        entries = F.array_sort(F.map_entries(name))
        return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")

    return out.withColumns({name: text(name) for name in op.INSIGHT_GROUPS})


@register("project_stats",
    f"""SELECT COUNT(*) AS total_projects, CAST(SUM(FLOOR(o_totalprice)) AS BIGINT) AS total_revenue, {q.ratio('CAST(SUM(FLOOR(o_totalprice)) AS HUGEINT)', 'COUNT(*)', 2)} AS avg_cost,
        CAST(COUNT_IF(o_orderstatus = 'F') AS BIGINT) AS completed, CAST(COUNT_IF(o_orderstatus <> 'F') AS BIGINT) AS delayed,
        {q.pct("COUNT_IF(o_orderstatus = 'F')", 'COUNT(*)')} AS completion_rate FROM orders""")
def project_stats(spark, base):
    return op.project_stats(quality.clean_projects(_projects(spark, base), AT))


@register("hr_summary", q.with_(
    f"""SELECT COUNT(*) AS total_employees, CAST(COUNT_IF(salary > 0) AS BIGINT) AS active_employees, {q.avg('salary')} AS avg_salary_ghs, CAST(MAX(salary) AS DOUBLE) AS max_salary_ghs,
        CAST(MIN(salary) AS DOUBLE) AS min_salary_ghs, {q.ratio('SUM(c_nationkey)', '(5*COUNT(*))', 2)} AS avg_performance,
        'Junior=' || COUNT_IF(salary < 5000) || ';Mid=' || COUNT_IF(salary >= 5000 AND salary < 8000) || ';Senior=' || COUNT_IF(salary >= 8000) AS salary_bands,
        (SELECT STRING_AGG(d || '=' || n, ';' ORDER BY d) FROM (SELECT UPPER(TRIM(department)[1]) || LOWER(TRIM(department)[2:]) AS d, COUNT(*) AS n FROM hr_checked WHERE reason IS NULL GROUP BY 1) m) AS departments
        FROM hr_checked WHERE reason IS NULL""", _HR))
def hr_summary(spark, base):
    valid, _ = quality.split_valid(quality.validate_records(_hr(spark, base), quality.hr_rules()))
    out = op.hr_summary(quality.clean_hr(valid, AT))

    def text(name):
        entries = F.array_sort(F.map_entries(name))
        return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")

    return out.withColumns({name: text(name) for name in ("salary_bands", "departments")})
