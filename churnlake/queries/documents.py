"""Nested documents derived from the tables and flattened again."""

from pyspark.sql import functions as F

from churnlake.plans.bounded import scratch_path
from churnlake.queries import sql as q
from churnlake.queries.registry import register
from churnlake.sources import documents as op
from churnlake.sources.tables import table


def _profiles(spark, base):
    """Customers as country payloads with the gaps such payloads have."""
    c = table(spark, base, "customer")
    segment = F.col("c_mktsegment")
    currency = F.struct(F.lower(segment).alias("name"), F.substring(segment, 1, 1).alias("symbol"))
    languages = F.create_map(F.lit("a"), F.col("c_name"), F.lit("b"), F.lower("c_name"))
    return c.select(
        F.struct(F.col("c_name").alias("common"), F.concat(F.lit("Republic of "), "c_name").alias("official")).alias("name"),
        F.when(segment == "BUILDING", F.array().cast("array<string>")).when(segment != "FURNITURE", F.array("c_name", segment)).alias("capital"),
        (F.col("c_custkey") * 1000).alias("population"),
        F.when(F.col("c_nationkey") > 2, F.col("c_acctbal")).alias("area"),
        segment.alias("region"),
        F.when(F.col("c_nationkey") < 20, F.concat(segment, F.lit(" part"))).alias("subregion"),
        F.when(F.col("c_nationkey") != 9, F.create_map(segment, currency)).alias("currencies"),
        F.when(F.col("c_nationkey") != 4, languages).alias("languages"),
        F.array(F.lit("UTC"), F.lit("UTC+01:00")).alias("timezones"),
    )


@register("json_flatten",
    """SELECT c_name AS name, 'Republic of ' || c_name AS official_name, CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'N/A' ELSE c_name END AS capital,
       c_custkey * 1000 AS population, CASE WHEN c_nationkey > 2 THEN c_acctbal ELSE 0 END AS area_km2, c_mktsegment AS region,
       CASE WHEN c_nationkey < 20 THEN c_mktsegment || ' part' ELSE 'N/A' END AS subregion,
       CASE WHEN c_nationkey <> 9 THEN c_mktsegment ELSE 'N/A' END AS currency_code, CASE WHEN c_nationkey <> 9 THEN LOWER(c_mktsegment) ELSE 'N/A' END AS currency_name,
       CASE WHEN c_nationkey <> 4 THEN c_name || ', ' || LOWER(c_name) ELSE '' END AS languages, 'UTC' AS timezones FROM customer""")
def json_flatten(spark, base):
    path = scratch_path(spark, "profiles")
    _profiles(spark, base).write.json(path)
    return op.json_flatten(spark.read.schema(op.COUNTRY_SCHEMA.replace("\n", " ")).json(path))


@register("variant_flatten",
    """SELECT c_name AS name, CASE WHEN c_nationkey % 3 <> 1 THEN 'Republic of ' || c_name END AS official_name,
       CASE WHEN c_nationkey % 2 = 0 THEN c_name WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'N/A' ELSE c_name END AS capital,
       c_custkey * 1000 AS population, CASE WHEN c_nationkey > 2 THEN c_acctbal ELSE 0 END AS area_km2, c_mktsegment AS region,
       CASE WHEN c_nationkey < 20 THEN c_mktsegment || ' part' ELSE 'N/A' END AS subregion,
       CASE WHEN c_nationkey <> 9 THEN c_mktsegment ELSE 'N/A' END AS currency_code, CASE WHEN c_nationkey <> 9 THEN LOWER(c_mktsegment) ELSE 'N/A' END AS currency_name,
       CASE WHEN c_nationkey <> 4 THEN c_name || ', ' || LOWER(c_name) ELSE '' END AS languages, 'UTC' AS timezones FROM customer""")
def variant_flatten(spark, base):
    """The profiles in several shapes: a bare capital, a bare name, a population in quotes."""
    c = _profiles(spark, base).withColumns({"_name": F.col("name.common"), "_key": (F.col("population") / 1000).cast("bigint")})
    nation = table(spark, base, "customer").select(F.col("c_custkey").alias("_key"), "c_nationkey")
    odd = c.join(nation, "_key").withColumn("population", F.col("population").cast("string"))
    fields = ["population", "area", "region", "subregion", "currencies", "languages", "timezones"]

    def shape(name, capital):
        return F.to_json(F.struct(F.col(name).alias("name"), F.col(capital).alias("capital"), *fields))

    even, bare = F.col("c_nationkey") % 2 == 0, F.col("c_nationkey") % 3 == 1
    text = (
        F.when(even & bare, shape("_name", "_name"))
        .when(even, shape("name", "_name"))
        .when(bare, shape("_name", "capital"))
        .otherwise(shape("name", "capital"))
    )
    path = scratch_path(spark, "documents")
    odd.select(text.alias("value")).write.text(path)
    return op.variant_flatten(op.read_variants(spark, path))


def _observations(spark, base):
    """Each order as an indicator payload: a page header, then a value, a zero and a null."""
    year = F.year("o_orderdate")
    value = F.floor("o_totalprice") * F.lit(1e7)

    def observation(back, v):
        return F.struct((year - back).cast("string").alias("date"), v.cast("double").alias("value"))

    pair = F.to_json(F.array(observation(0, value), observation(1, F.lit(0)), observation(2, F.lit(None))))
    return table(spark, base, "orders").select(
        F.col("o_orderkey").alias("code"), F.col("o_orderstatus").alias("name"), F.concat(F.lit('[{"page":1},'), pair, F.lit("]")).alias("payload")
    )


@register("json_unnest_filter",
    """SELECT o_orderkey AS country_code, o_orderstatus AS country_name, CAST(YEAR(o_orderdate) AS INTEGER) AS year,
       FLOOR(o_totalprice) * 1e7 AS gdp_usd, CAST(FLOOR(o_totalprice) AS DOUBLE) / 100 AS gdp_billions FROM orders""")
def json_unnest_filter(spark, base):
    return op.json_unnest_filter(_observations(spark, base), "payload", "code", "name")


@register("unit_ratios",
    """SELECT c_custkey, ROUND(ROUND(c_acctbal) * 1e9 / NULLIF(c_custkey, 0), 2) AS gdp_per_capita_usd, ROUND(c_custkey / CAST(NULLIF(c_nationkey, 0) AS DOUBLE), 2) AS pop_density_per_km2
       FROM customer""")
def unit_ratios(spark, base):
    df = table(spark, base, "customer").select(
        "c_custkey",
        F.col("c_custkey").alias("population"),
        F.floor(F.abs("c_acctbal") + 0.5).alias("_b"),
        F.col("c_acctbal"),
        F.col("c_nationkey").cast("double").alias("area_km2"),
    )
    df = df.withColumn("gdp_billions", (F.col("_b") * F.signum("c_acctbal")).cast("double"))
    return op.unit_ratios(df).select("c_custkey", "gdp_per_capita_usd", "pop_density_per_km2")


_MICROS = "SUM(CAST(CAST(value AS DECIMAL(28,6)) * 1000000 AS HUGEINT))"


@register("weather_summary",
    f"""SELECT event_type AS name, COUNT(user_id) AS cities_monitored, {q.ratio(_MICROS, '(1000000*COUNT(value))', 2)} AS avg_temp_c, {q.avg('k')} AS avg_humidity_pct,
       CAST(COUNT_IF(k BETWEEN 51 AND 67 OR k BETWEEN 80 AND 82) AS BIGINT) AS cities_raining
       FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events) e GROUP BY event_type""")
def weather_summary(spark, base):
    code = F.get_json_object("props", "$.k").try_cast("int")
    events = table(spark, base, "events").select(
        F.col("event_type").alias("country"),
        F.col("user_id").alias("city"),
        F.col("value").alias("temperature_c"),
        code.alias("humidity_pct"),
        code.alias("weather_code"),
    )
    return op.weather_summary(op.with_rain_flag(events))
