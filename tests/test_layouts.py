"""Curve layouts, drifting files and SQL table functions."""

import datetime as dt

import pytest
from compare import rows
from pyspark.sql import functions as F

from churnlake.operators import tablefunctions
from churnlake.sinks import curve
from churnlake.sources import drift
from churnlake.sources.subscriptions import subscriptions
from test_plans import plan


def _rows_read(df):
    """Rows that the file scans of a finished query gave, after row groups were skipped."""
    df.collect()
    todo, read = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        n = todo.pop()
        kind = n.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(n.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(n.plan())
        else:
            if kind == "FileSourceScanExec":
                read += n.metrics().get("numOutputRows").get().value()
            children = n.children()
            todo += [children.apply(i) for i in range(children.size())]
    return read


@pytest.fixture(scope="module")
def spread(spark):
    """40,000 rows with five columns that do not depend on each other, a third with one charge."""
    h = lambda salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1_000_000))
    return spark.range(40_000).select(
        "id",
        F.element_at(F.array(*[F.lit(x) for x in ("Month-to-month", "One year", "Two year")]), (h(1) % 3 + 1).cast("int")).alias("contract"),
        (h(2) % 4 == 0).cast("int").alias("churn"),
        F.when(h(3) % 3 == 0, 20.0).otherwise(h(4) / 10_000).cast("decimal(18,2)").alias("charge"),
        (h(5) % 72).cast("int").alias("tenure"),
    )


COLUMNS = ["contract", "churn", "charge", "tenure"]


@pytest.mark.parametrize("where", ["contract = 'One year'", "churn = 1", "contract = 'One year' and churn = 1", "charge >= 90", "tenure <= 6"])
def test_each_filter_column_skips_row_groups(spark, spread, tmp_path, where):
    curve.layout_by_curve(spread, str(tmp_path / "t"), COLUMNS, files=64)
    stored = spark.read.parquet(str(tmp_path / "t"))
    hit = stored.filter(where)
    assert _rows_read(hit) < 0.8 * 40_000
    assert rows(hit, *stored.columns) == rows(spread.filter(where), *stored.columns)
    assert stored.count() == 40_000


def test_a_hot_place_is_spread_over_files(spark, tmp_path):
    """All rows in one place of the curve."""
    df = spark.range(20_000).select("id", F.lit("x").alias("a"), F.lit(1).alias("b"))
    curve.layout_by_curve(df, str(tmp_path / "t"), ["a", "b"], files=8)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 6_000


def test_bloom_filter_skips_row_groups_of_a_point_lookup(spark, spread, tmp_path):
    even = spread.withColumn("key", F.col("id") * 2)
    curve.layout_by_curve(even, str(tmp_path / "t"), COLUMNS, lookups={"key": 5_000}, files=8)
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert _rows_read(stored.filter("key = 40001")) == 0  # within every minimum and maximum, in no filter
    assert [r["id"] for r in stored.filter("key = 40002").collect()] == [20_001]


def test_curve_with_nulls_empty_tables_repeats_and_odd_names(spark, tmp_path):
    data = [(None, None, None), ("é", float("nan"), dt.date(2020, 1, 1)), ("é", 1.0, None), ("é", 1.0, None), ("", -1e300, dt.date(1, 1, 1))]
    df = spark.createDataFrame(data, "`_0` string, at double, `a``b.c` date").withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    curve.layout_by_curve(df, str(tmp_path / "t"), ["_0", "at", "`a``b.c`"][:2])
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.columns == df.columns and stored.count() == 5
    assert stored.filter("`_0` = 'é' and at = 1").count() == 2
    curve.layout_by_curve(df.limit(0), str(tmp_path / "e"), ["_0", "at"])
    assert spark.read.schema(df.schema).parquet(str(tmp_path / "e")).count() == 0
    with pytest.raises(ValueError):
        curve.layout_by_curve(df, str(tmp_path / "n"), [])


def test_curve_position_is_a_column_of_the_sort(spark, spread, tmp_path):
    """A sort key that is an expression is computed again for each comparison of rows."""
    ends = curve.cuts(spread, COLUMNS)
    placed = curve._placed(spread, ends, curve.BITS)
    assert [r[-1] for r in placed.collect()] == [r["z"] for r in spread.select(curve.curve_position(spread, ends).alias("z")).collect()]
    ran = []
    order = type(spread).sortWithinPartitions
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spread), "sortWithinPartitions", lambda df, *by: ran.append(out := order(df, *by)) or out)
        curve.layout_by_curve(spread, str(tmp_path / "t"), COLUMNS, files=4)
    plan = ran[0]._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert all("CASE" not in line and "conv(" not in line and " > " not in line for line in plan if "Sort [" in line or "RepartitionByExpression" in line)
    assert sum(line.count("conv(") for line in plan) == 1
    assert spark.read.parquet(str(tmp_path / "t")).columns == spread.columns


def test_curve_takes_bits_in_turn(spark):
    df = spark.createDataFrame([(x, y) for x in range(4) for y in range(4)], "x int, y int")
    ends = {"x": [0.0, 1.0, 2.0], "y": [0.0, 1.0, 2.0]}
    got = {(r["x"], r["y"]): r["z"] for r in df.withColumn("z", curve.curve_position(df, ends, 2)).collect()}
    plain = {(x, y): (x >> 1) * 8 + (y >> 1) * 4 + (x & 1) * 2 + (y & 1) for x in range(4) for y in range(4)}
    assert got == plain


def _write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


@pytest.mark.parametrize(
    "values, kind",
    [
        (["1", "2"], "int"), (["1", "3000000000"], "bigint"), (["1", "2.5"], "double"), (["3000000000", "1e3"], "double"),
        (["1", "x"], "string"), (["true", "FALSE"], "boolean"), (["true", "1"], "string"), (["2020-01-31", ""], "date"),
        (["2020-01-31", "2020-01-31 10:00:00"], "timestamp"), (["2020-02-31"], "string"), (["", ""], "string"),
        (["99999999999999999999"], "string"), (["1d"], "string"), (["NaN"], "string"), (["2020-01-01", "5"], "string"),
    ],
)
def test_types_widen(spark, tmp_path, values, kind):
    for i, v in enumerate(values):
        _write(tmp_path, **{f"f{i}": f"k,v\n{i},{v}\n"})
    found = drift.schema_of_files(spark, str(tmp_path))
    assert [(n, t) for n, t, *_ in found.columns] == [("k", "int"), ("v", kind)]
    assert found.read().count() == len(values)


def test_drifting_headers_lose_nothing(spark, tmp_path):
    path = _write(
        tmp_path, a="ID,Plan Name,source\n1,x,s\n2,\"two\nlines\",\n", b="extra,id\n7.5,3\n", c="Id,ID,source_file,a`b\n4,5,own,q\n", d="id,only\n"
    )
    found = drift.schema_of_files(spark, path)
    assert found.columns == [
        ("id", "int", 4, 3), ("plan_name", "string", 2, 1), ("source", "string", 1, 1), ("extra", "double", 1, 1),
        ("id_1", "int", 1, 1), ("source_file_2", "string", 1, 1), ("a`b", "string", 1, 1), ("only", "string", 0, 0),
    ]
    got = {r["id"]: r.asDict() for r in found.read().collect()}
    assert got[1]["plan_name"] == "x" and got[1]["source"] == "s" and got[2]["plan_name"] == "two\nlines" and got[2]["source"] is None
    assert got[3]["extra"] == 7.5 and got[4]["id_1"] == 5 and got[4]["source_file_2"] == "own" and got[4]["a`b"] == "q"
    assert len(got) == 4 and "only" in found.schema.names


def test_no_files_and_bad_bytes(spark, tmp_path):
    assert drift.schema_of_files(spark, str(tmp_path)).read().count() == 0
    (tmp_path / "x.csv").write_bytes(b"a,b\n1,\xff\xfe\n")
    with pytest.raises(ValueError, match="UTF-8"):
        drift.schema_of_files(spark, str(tmp_path))


def test_table_function_conditions_reach_the_scan(spark, base):
    subscriptions(spark, base, "contract", "internet_service", "monthly_charges", "churn").createOrReplaceTempView("tf_view")
    tablefunctions.create_segment_performance(spark, "tf_segments", "tf_view")
    one = plan(spark.sql("SELECT * FROM tf_segments(:c)", {"c": "Two year"}))
    scan = next(x for x in one.splitlines() if "o_orderstatus" in x and "FileScan" in x)
    assert "DataFilters: [CASE WHEN" in scan or "EqualTo(o_orderstatus" in scan
    assert spark.sql("SELECT * FROM tf_segments()").count() == spark.sql("SELECT * FROM tf_segments('', NULL)").count() == 9
    assert spark.sql("SELECT * FROM tf_segments('none')").count() == 0
    spark.createDataFrame([], "contract string, internet_service string, monthly_charges decimal(18,2), churn int").createOrReplaceTempView("tf_none")
    tablefunctions.create_segment_performance(spark, "tf_empty", "tf_none")
    assert spark.sql("SELECT * FROM tf_empty()").count() == 0
    with pytest.raises(ValueError):
        tablefunctions.create_risk_report(spark, "x; DROP", "tf_view")
