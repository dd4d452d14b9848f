"""Nested JSON payloads flattened to tables.

Payload files are stored by another process; here they are only parsed. A field the
payload lacks gives the default, not an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.functions.numbers import rounded
from churnlake.functions.scoring import is_raining

# Schema of a country profile as the payload stores it.
COUNTRY_SCHEMA = """
name struct<common: string, official: string>,
capital array<string>,
population bigint,
area double,
region string,
subregion string,
currencies map<string, struct<name: string, symbol: string>>,
languages map<string, string>,
timezones array<string>
"""

def first_or(c: Column, default: str = "N/A") -> Column:
    """First array element, or the default when the array is absent or empty."""
    return F.coalesce(F.try_element_at(c, F.lit(1)), F.lit(default))


def json_flatten(df: DataFrame) -> DataFrame:
    """Country profile to flat columns."""
    codes = F.map_keys("currencies")
    names = F.transform(F.map_values("currencies"), lambda v: v["name"])
    return df.select(
        F.col("name.common").alias("name"),
        F.col("name.official").alias("official_name"),
        first_or(F.col("capital")).alias("capital"),
        "population",
        F.coalesce("area", F.lit(0.0)).alias("area_km2"),
        "region",
        F.coalesce("subregion", F.lit("N/A")).alias("subregion"),
        first_or(codes).alias("currency_code"),
        first_or(names).alias("currency_name"),
        F.coalesce(F.array_join(F.map_values("languages"), ", "), F.lit("")).alias("languages"),
        first_or(F.col("timezones")).alias("timezones"),
    )


def read_variants(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Documents of any shape as they are: one column ``doc`` of VARIANT, each parsed once. A
    document that is no JSON is null."""
    reader = spark.read.option("multiLine", one_per_file).option("singleVariantColumn", "doc").option("mode", "PERMISSIVE")
    return reader.json(path)


def _text(doc: str, path: str) -> Column:
    return F.try_variant_get(F.col(doc), path, "string")


def _first_of(doc: str, path: str) -> Column:
    """A list's first element, or the value itself where a document has it bare."""
    return F.coalesce(_text(doc, f"{path}[0]"), F.when(~_shape(doc, path).startswith("ARRAY"), _text(doc, path)), F.lit("N/A"))


def _shape(doc: str, path: str) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_variant_get(F.col(doc), path, "variant")), F.lit("VOID"))


def variant_flatten(df: DataFrame, doc: str = "doc") -> DataFrame:
    """Country profiles of any shape to the flat columns of ``json_flatten``.

    A field of another type than usual is kept where its value can be read: a single capital
    that is no list, a population or area in quotes. Fields that are missing or can't be read
    give the defaults. Every document gives a row, also one that is null.
    """
    fields = F.try_variant_get(F.col(doc), "$.currencies", "map<string,variant>")
    languages = F.try_variant_get(F.col(doc), "$.languages", "map<string,string>")
    names = F.transform(F.map_values(fields), lambda v: F.coalesce(F.try_variant_get(v, "$.name", "string"), F.try_variant_get(v, "$", "string")))
    return df.select(
        F.coalesce(_text(doc, "$.name.common"), F.when(~_shape(doc, "$.name").startswith("OBJECT"), _text(doc, "$.name"))).alias("name"),
        _text(doc, "$.name.official").alias("official_name"),
        _first_of(doc, "$.capital").alias("capital"),
        F.try_variant_get(F.col(doc), "$.population", "bigint").alias("population"),
        F.coalesce(F.try_variant_get(F.col(doc), "$.area", "double"), F.lit(0.0)).alias("area_km2"),
        _text(doc, "$.region").alias("region"),
        F.coalesce(_text(doc, "$.subregion"), F.lit("N/A")).alias("subregion"),
        first_or(F.map_keys(fields)).alias("currency_code"),
        first_or(names).alias("currency_name"),
        F.coalesce(F.array_join(F.map_values(languages), ", "), F.lit("")).alias("languages"),
        _first_of(doc, "$.timezones").alias("timezones"),
    )


def json_unnest_filter(df: DataFrame, payload: str, code: str, name: str) -> DataFrame:
    """Observations in the second element of the payload pair; null and 0 are dropped.

    The payload is parsed once, to VARIANT, whatever its two elements look like; one that is
    no JSON or has no list there gives no rows. Numbers in quotes count.
    """
    parsed = df.select(code, name, F.try_parse_json(payload).alias("_doc"))
    pair = F.try_variant_get(F.col("_doc"), "$[1]", "variant")
    items = parsed.select(code, name, pair.alias("_items")).lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_items").outer()))
    value = F.try_variant_get(F.col("value"), "$.value", "double")
    found = items.filter("key is null").select(code, name, value.alias("_v"), F.try_variant_get(F.col("value"), "$.date", "string").alias("_d"))
    return found.filter("_v is not null and _v <> 0").select(
        F.col(code).alias("country_code"),
        F.col(name).alias("country_name"),
        F.col("_d").try_cast("int").alias("year"),
        F.col("_v").alias("gdp_usd"),
        F.round(F.col("_v") / 1e9, 2).alias("gdp_billions"),
    )


def unit_ratios(df: DataFrame) -> DataFrame:
    """Value per head, from the rounded billions, and density; null without a divisor."""
    return df.withColumns(
        {
            "gdp_per_capita_usd": F.round(F.try_divide(F.col("gdp_billions") * 1e9, F.col("population")), 2),
            "pop_density_per_km2": F.round(F.try_divide(F.col("population"), F.col("area_km2")), 2),
        }
    )


def _mean(c: str) -> Column:
    """Mean of six-digit decimals, which does not depend on the order of tasks."""
    return rounded(F.avg(F.col(c).cast("decimal(20,6)")), 2)


def weather_summary(df: DataFrame) -> DataFrame:
    """Cities, means and rainy cities per country."""
    return df.groupBy(F.col("country").alias("name")).agg(
        F.count("city").alias("cities_monitored"),
        _mean("temperature_c").alias("avg_temp_c"),
        _mean("humidity_pct").alias("avg_humidity_pct"),
        F.count_if("is_raining").alias("cities_raining"),
    )


def with_rain_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_raining", is_raining(F.col("weather_code")))
