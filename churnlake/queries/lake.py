"""Sources and sinks bound to the tables: each query writes what it then reads."""

import uuid

from pyspark.sql import functions as F

from churnlake.functions import text
from churnlake.functions.numbers import as_double, churn_rate, total
from churnlake.plans.bounded import freeze, scratch_path
from churnlake.queries import sql as q
from churnlake.queries.registry import register
from churnlake.queries.scored import scored
from churnlake.sinks import curve
from churnlake.sinks import files as sink
from churnlake.sources import drift
from churnlake.sources import files as source
from churnlake.sources.subscriptions import subscriptions as subs
from churnlake.sources.tables import table

_PART = "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part"
_PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double"


def _part(spark, base):
    return table(spark, base, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")


def _part_csv(spark, base):
    path = scratch_path(spark, "part-csv")
    sink.write_csv(_part(spark, base), path)
    return path


@register("read_csv_inferred", """SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_size, p_retailprice FROM part""")
def read_csv_inferred(spark, base):
    return source.read_csv_inferred(spark, _part_csv(spark, base))


@register("read_csv_schema", _PART)
def read_csv_schema(spark, base):
    return source.read_csv_schema(spark, _part_csv(spark, base), _PART_SCHEMA)


@register("read_csv_tolerant",
    """SELECT conv_id, turn, role, CASE WHEN turn % 2 = 0 THEN text END AS text, turn % 2 = 1 AS short_row FROM conversations""")
def read_csv_tolerant(spark, base):
    """Conversations as CSV text: quoted newlines, and every other row without its last field."""
    path = scratch_path(spark, "jagged-csv")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('\\"')), F.lit('"'))
    fields = [F.col(c).cast("string") for c in ("conv_id", "turn", "role")]
    line = F.concat_ws(",", *fields, F.when(F.col("turn") % 2 == 0, F.replace(quoted, F.lit("\\\\"), F.lit("\\"))))
    table(spark, base, "conversations").select(line.alias("value")).write.text(path)
    schema = "conv_id bigint, turn bigint, role string, text string"
    df = source.read_csv_tolerant(spark, path, schema, header=False)
    return df.select("conv_id", "turn", "role", "text", F.col(source.CORRUPT).isNotNull().alias("short_row"))


@register("read_json_documents", "SELECT n_nationkey AS nation, c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer JOIN nation ON n_nationkey = c_nationkey")
def read_json_documents(spark, base):
    """One payload per nation with its customers as items."""
    path = scratch_path(spark, "payloads")
    item = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    # A nation's list is split by a salt, so no payload grows with the whole nation.
    payloads = (
        table(spark, base, "customer")
        .groupBy(F.col("c_nationkey").alias("nation"), F.floor(F.col("c_custkey") / 1000).alias("page"))
        .agg(F.collect_list(item).alias("items"))
    )
    payloads.write.json(path)
    schema = "nation int, page bigint, items array<struct<id: bigint, name: string, balance: double>>"
    docs = source.read_json_documents(spark, path, "items", schema, one_per_file=False)
    return docs.select(F.col("doc_nation").alias("nation"), "id", "name", "balance")


@register("read_or_empty", f"{_PART}")
def read_or_empty(spark, base):
    missing = source.read_or_empty(spark, scratch_path(spark, "missing"), _PART_SCHEMA)
    return source.read_or_empty(spark, _part_csv(spark, base), _PART_SCHEMA).unionByName(missing)


@register("latest_file", "SELECT p_brand, COUNT(*) AS n FROM part WHERE p_size > 25 GROUP BY p_brand")
def latest_file(spark, base):
    """Two drops of any number of files; the newer holds the larger parts."""
    root = scratch_path(spark, "drops")
    small, large = _part(spark, base).filter("p_size <= 25"), _part(spark, base).filter("p_size > 25")
    sink.write_csv(small, f"{root}/a")
    sink.write_csv(large, f"{root}/b")
    newest = source.latest_drop(spark, root)
    return source.read_csv_schema(spark, newest, _PART_SCHEMA).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@register("read_all_under_prefix", _PART)
def read_all_under_prefix(spark, base):
    root = scratch_path(spark, "prefix")
    part = _part(spark, base)
    sink.write_csv(part.filter("p_size <= 25"), f"{root}/2024/small")
    sink.write_csv(part.filter("p_size > 25"), f"{root}/2025/large")
    part.write.json(f"{root}/2025/other")
    return source.read_all_under_prefix(spark, root, _PART_SCHEMA)


@register("lake_inventory")
def lake_inventory(spark, base):
    root = scratch_path(spark, "lake")
    df = subs(spark, base, "customer_id", "contract", "tenure")
    sink.write_csv(df, f"{root}/raw/customers")
    sink.write_partitioned(df, f"{root}/processed/customers", ["contract"])
    return source.lake_inventory(spark, root)


_LINE = "LENGTH(CAST(customer_id AS VARCHAR)) + LENGTH(contract) + LENGTH(CAST(tenure AS VARCHAR)) + 3"
_HEADER = len("customer_id,contract,tenure") + 1


@register("lake_inventory_bytes", q.subs(
    f"""SELECT 'raw' AS folder, CAST(4 AS BIGINT) AS objects, CAST(SUM({_LINE}) + 4 * {_HEADER} AS BIGINT) AS bytes FROM subs
        UNION ALL SELECT 'processed', 1, CAST(SUM({_LINE}) + {_HEADER} AS BIGINT) FROM subs WHERE churn = 1"""))
def lake_inventory_bytes(spark, base):
    """Plain text files, whose sizes follow from the rows: four files of all and one of a part."""
    root = scratch_path(spark, "lake")
    df = subs(spark, base, "customer_id", "contract", "tenure", "churn")
    sink.write_csv(df.select("customer_id", "contract", "tenure").repartition(4), f"{root}/raw/customers")
    sink.write_single_file(df.filter("churn = 1").select("customer_id", "contract", "tenure"), f"{root}/processed/churned")
    return source.lake_inventory(spark, root)


@register("schema_from_sample", """SELECT p_size, COUNT(*) AS n, CAST(SUM(CAST(p_retailprice * 100 AS BIGINT)) AS BIGINT) AS cents FROM part GROUP BY p_size""")
def schema_from_sample(spark, base):
    path = _part_csv(spark, base)
    schema = source.schema_from_sample(spark, source.latest_file(spark, path))
    df = source.read_csv_schema(spark, path, schema)
    return df.groupBy("p_size").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("p_retailprice") * 100).cast("bigint")).alias("cents"))


@register("write_csv", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def write_csv(spark, base):
    path = scratch_path(spark, "csv")
    sink.write_csv(table(spark, base, "supplier").select("s_suppkey", "s_name", "s_acctbal"), path)
    return source.read_csv_schema(spark, path, "s_suppkey bigint, s_name string, s_acctbal double")


_BY_CONTRACT = f"SELECT contract, COUNT(*) AS customers, {q.REVENUE} AS revenue FROM subs GROUP BY contract"


@register("write_single_file", q.subs(_BY_CONTRACT))
def write_single_file(spark, base):
    path = scratch_path(spark, "single")
    summary = subs(spark, base, "contract", "monthly_charges").groupBy("contract").agg(
        F.count(F.lit(1)).alias("customers"), total("monthly_charges").alias("revenue")
    )
    sink.write_single_file(summary, path)
    return source.read_csv_schema(spark, path, "contract string, customers bigint, revenue double")


@register("write_partitioned", q.subs(
    "SELECT LOWER(REPLACE(REPLACE(contract, '-', '_'), ' ', '_')) AS contract_slug, churn, COUNT(*) AS n FROM subs GROUP BY ALL"))
def write_partitioned(spark, base):
    path = scratch_path(spark, "partitioned")
    df = subs(spark, base, "customer_id", "contract", "churn").withColumn("contract_slug", text.partition_slug("contract"))
    sink.write_partitioned(df, path, ["contract_slug", "churn"])
    stored = spark.read.parquet(path)
    return stored.groupBy("contract_slug", "churn").agg(F.count(F.lit(1)).alias("n"))


@register("write_json_report", q.subs(
    f"""SELECT 'churn' AS pipeline_name, COUNT(*) AS total_customers, {q.pct('SUM(churn)', 'COUNT(*)', 2)} AS churn_rate_pct, {q.REVENUE} AS monthly_revenue FROM subs"""))
def write_json_report(spark, base):
    path = scratch_path(spark, "report")
    report = subs(spark, base, "monthly_charges", "churn").agg(
        F.count(F.lit(1)).alias("total_customers"),
        churn_rate(digits=2).alias("churn_rate_pct"),
        total("monthly_charges").alias("monthly_revenue"),
    )
    report = report.select(F.lit("churn").alias("pipeline_name"), F.struct(*report.columns).alias("executive_summary"))
    sink.write_json_report(report, path)
    stored = spark.read.schema(
        "pipeline_name string, executive_summary struct<total_customers: bigint, churn_rate_pct: double, monthly_revenue: double>"
    ).json(path)
    return stored.select("pipeline_name", "executive_summary.*")


@register("ctas", q.subs(_BY_CONTRACT))
def ctas(spark, base):
    summary = subs(spark, base, "contract", "monthly_charges").groupBy("contract").agg(
        F.count(F.lit(1)).alias("customers"), total("monthly_charges").alias("revenue")
    )
    return sink.ctas(summary, f"contract_totals_{uuid.uuid4().hex}", scratch_path(spark, "ctas"))


@register("split_outputs", q.subs(
    f"""SELECT 'enriched' AS output, COUNT(*) AS n, {q.REVENUE} AS charges FROM s UNION ALL
        SELECT 'high_risk', COUNT(*), {q.REVENUE} FROM s WHERE churn = 0 AND risk_score >= 5 UNION ALL
        SELECT 'intervention', COUNT(*), {q.REVENUE} FROM s WHERE churn = 0 AND risk_score >= 7""", f"s AS (SELECT *, {q.SCORE} AS risk_score FROM subs)"))
def split_outputs(spark, base):
    root = scratch_path(spark, "outputs")
    parts = []
    for name in sink.write_split_outputs(scored(spark, base), root):
        rows = spark.read.parquet(f"{root}/{name}")
        parts.append(rows.agg(F.count(F.lit(1)).alias("n"), total("monthly_charges").alias("charges")).select(F.lit(name).alias("output"), "*"))
    return parts[0].union(parts[1]).union(parts[2])


@register("audit_columns", q.subs(
    """SELECT customer_id, '2026-01-01 00:00:00' AS run_date, 'etl' AS run_by, 'v1' AS pipeline_version, 'orders' AS data_source FROM subs"""))
def audit_columns(spark, base):
    return sink.audit_columns(subs(spark, base, "customer_id"), "2026-01-01 00:00:00", "etl", "v1", "orders")


@register("layout_for_filters", q.subs(
    f"SELECT customer_id, CAST(monthly_charges AS DOUBLE) AS monthly_charges FROM subs WHERE contract = 'One year' AND churn = 1 AND monthly_charges >= {100 * q.UNIT}"))
def layout_for_filters(spark, base):
    path = scratch_path(spark, "layout")
    df = subs(spark, base, "customer_id", "contract", "churn", "monthly_charges", "tenure")
    sink.layout_for_filters(df, path, "contract", ["churn", "monthly_charges", "tenure"])
    hit = spark.read.parquet(path).filter(
        (F.col("contract") == "One year") & (F.col("churn") == 1) & (F.col("monthly_charges") >= 100 * q.UNIT)
    )
    return hit.select("customer_id", as_double("monthly_charges").alias("monthly_charges"))


@register("repartition_coalesce", """SELECT 'spread' AS step, CAST(8 AS BIGINT) AS partitions, COUNT(*) AS n FROM orders
    UNION ALL SELECT 'merged', CAST(2 AS BIGINT), COUNT(*) FROM orders""")
def repartition_coalesce(spark, base):
    frames = sink.repartition_coalesce(subs(spark, base, "customer_id"), 8, 2)
    sizes = [
        df.groupBy(F.spark_partition_id().alias("p"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count(F.lit(1)).alias("partitions"), F.sum("n").alias("n"))
        .select(F.lit(name).alias("step"), "*")
        for name, df in frames.items()
    ]
    return sizes[0].union(sizes[1])


@register("cache_reuse", q.subs(
    """SELECT 'all' AS subset, COUNT(*) AS n FROM subs UNION ALL SELECT 'churned', COUNT(*) FROM subs WHERE churn = 1
       UNION ALL SELECT 'flexible', COUNT(*) FROM subs WHERE contract = 'Month-to-month'"""))
def cache_reuse(spark, base):
    """Three actions on one kept frame; their three counts are the result."""
    with sink.reused(subs(spark, base, "contract", "churn")) as kept:
        counts = [("all", kept.count()), ("churned", kept.filter("churn = 1").count()), ("flexible", kept.filter("contract = 'Month-to-month'").count())]
    return spark.createDataFrame(counts, "subset string, n bigint")


# Filters of the columns that reports filter on, and of a key.
_CURVE_FILTERS = {
    "contract": "contract = 'One year'",
    "churn": "churn = 1",
    "contract and churn": "contract = 'Two year' AND churn = 1",
    "monthly_charges": f"monthly_charges >= {100 * q.UNIT}",
    "tenure": "tenure <= 12",
    "customer_id": "customer_id % 1000 = 7 AND customer_id <= 5000",
}


@register("layout_by_curve", q.subs(" UNION ALL ".join(
    f"SELECT '{name}' AS filter, COUNT(*) AS customers, {q.REVENUE} AS revenue FROM subs WHERE {where}" for name, where in _CURVE_FILTERS.items())))
def layout_by_curve(spark, base):
    """One stored table serves filters on any of its columns."""
    path = scratch_path(spark, "curve")
    df = freeze(subs(spark, base, "customer_id", "contract", "churn", "monthly_charges", "tenure"), "subscriptions")
    curve.layout_by_curve(df, path, ["contract", "churn", "monthly_charges", "tenure"], lookups={"customer_id": 1_000_000})
    stored = spark.read.schema(df.schema).parquet(path)
    parts = [
        stored.filter(where).agg(F.count(F.lit(1)).alias("customers"), total("monthly_charges").alias("revenue")).select(F.lit(name).alias("filter"), "*")
        for name, where in _CURVE_FILTERS.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _drifting_parts(spark, base):
    """Parts in three drops: sizes whole, then with a fraction and a column more in another
    order, then as text under a name in other case."""
    root = scratch_path(spark, "drift")
    df = _part(spark, base)
    key, size = F.col("p_partkey").alias("Part Key"), F.col("p_size")
    sink.write_csv(df.filter("p_size <= 10").select(key, size.alias("Size"), "p_retailprice"), f"{root}/a")
    sink.write_csv(df.filter("p_size between 11 and 40").select(F.col("p_brand").alias("Brand"), (size + 0.5).alias("Size"), key), f"{root}/b")
    sink.write_csv(df.filter("p_size > 40").select(key, (F.col("p_partkey") + 5_000_000_000).alias("CODE"), F.concat(F.lit("1990-01-"), F.lpad(F.pmod(size, F.lit(28)) + 1, 2, "0")).alias("made on"), size.alias("size")), f"{root}/c")
    return root


@register("schema_of_files",
    """SELECT 'part_key' AS name, 'int' AS type, COUNT(*) AS filled FROM part UNION ALL SELECT 'size', 'double', COUNT(p_size) FROM part
       UNION ALL SELECT 'p_retailprice', 'double', COUNT(p_retailprice) FROM part WHERE p_size <= 10
       UNION ALL SELECT 'brand', 'string', COUNT(p_brand) FROM part WHERE p_size BETWEEN 11 AND 40
       UNION ALL SELECT 'code', 'bigint', COUNT(*) FROM part WHERE p_size > 40 UNION ALL SELECT 'made_on', 'date', COUNT(*) FROM part WHERE p_size > 40""")
def schema_of_files(spark, base):
    return drift.schema_of_files(spark, _drifting_parts(spark, base)).table().select("name", "type", "filled")


@register("read_drifting_files",
    """SELECT CAST(p_partkey AS INTEGER) AS part_key, CAST(CASE WHEN p_size BETWEEN 11 AND 40 THEN p_size + 0.5 ELSE p_size END AS DOUBLE) AS size,
       CASE WHEN p_size <= 10 THEN p_retailprice END AS p_retailprice, CASE WHEN p_size BETWEEN 11 AND 40 THEN p_brand END AS brand,
       CASE WHEN p_size > 40 THEN p_partkey + 5000000000 END AS code, CASE WHEN p_size > 40 THEN CAST(DATE '1990-01-01' + CAST(p_size % 28 AS INTEGER) AS DATE) END AS made_on FROM part WHERE p_size IS NOT NULL""")
def read_drifting_files(spark, base):
    return drift.schema_of_files(spark, _drifting_parts(spark, base)).read().drop("source_file")
