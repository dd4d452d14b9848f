"""Nulls, band edges, ties, hot keys and empty input, against brute force on small frames."""

import random
from decimal import Decimal
from pathlib import Path

import numpy as np
import pytest
from compare import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from churnlake.functions import ladders, numbers, scoring, text
from churnlake.operators import aggregates, joins, quality, relational, warehouse, windows
from churnlake.operators.quality import ValidationError
from churnlake.plans import digits, ordering, runs
from churnlake.plans.bounded import freeze, frozen_scope
from churnlake.sinks import files as sink
from churnlake.sinks import versions
from churnlake.sources import calendar
from churnlake.sources import documents as docs
from churnlake.sources import files as source
from churnlake.sources.tables import table

SUBS = "customer_id bigint, contract string, payment_method string, tenure int, monthly_charges decimal(18,2), churn int"


def subs(spark, data):
    return spark.createDataFrame([(i, c, p, t, Decimal(str(m)), x) for i, c, p, t, m, x in data], SUBS)


@pytest.mark.parametrize("hot", [0.0, 0.5, 1.0])
def test_rankings_with_a_hot_value(spark, hot):
    """Row number, rank, dense rank and ntile equal a sort on the driver."""
    rng = random.Random(7)
    n = 2_000
    data = [(i, 5 if rng.random() < hot else rng.randrange(60)) for i in range(n)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "id bigint, v int")
    out = ordering.ranked(df, [("v", "desc")], ["id"], "rn", "rk", "dr", {"q": 7})
    ordered = sorted(data, key=lambda r: (-r[1], r[0]))
    first, dense = {}, {}
    for i, (_, v) in enumerate(ordered):
        first.setdefault(v, i + 1)
        dense.setdefault(v, len(dense) + 1)
    size, extra = divmod(n, 7)
    tiles = [b + 1 for b in range(7) for _ in range(size + (b < extra))]
    expected = [(k, v, i + 1, tiles[i], first[v], dense[v]) for i, (k, v) in enumerate(ordered)]
    assert rows(out, "id", "v", "rn", "q", "rk", "dr") == sorted(expected, key=str)


def test_ntile_with_more_buckets_than_rows(spark):
    out = ordering.ranked(spark.range(3), [("id", "asc")], [], ntile={"q": 5})
    assert rows(out) == [(0, 1), (1, 2), (2, 3)]


def test_rankings_of_nulls_and_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, 4), (3, None)], "id bigint, v int")
    out = ordering.ranked(df, [("v", "asc")], ["id"], rank="rk")
    assert rows(out, "id", "rk") == [(1, 1), (2, 3), (3, 1)]
    assert ordering.ranked(df.filter("id > 9"), [("v", "asc")], ["id"], "rn").count() == 0


def test_ranks_of_many_ties(spark):
    df = spark.createDataFrame([(i, i % 10) for i in range(100)], "id bigint, v int")
    out = ordering.ranked(df, [("v", "asc")], ["id"], rank="rk", dense_rank="dr")
    assert rows(out.filter("v = 9").select("rk", "dr").distinct()) == [(91, 10)]


def test_top_ranks_keep_ties_without_sorting_rows(spark):
    df = spark.createDataFrame([(i, "g" if i % 3 else "h", 7 if i < 40 else i % 9) for i in range(120)], "id int, g string, v int")
    out = windows.rank_and_dense_top(df, "g", [("v", "desc")], 30)
    w = Window.partitionBy("g").orderBy(F.desc("v"))
    plain = df.withColumns({"r": F.rank().over(w), "d": F.dense_rank().over(w)}).filter("r <= 30")
    assert rows(out, "id", "spend_rank", "spend_dense_rank") == rows(plain, "id", "r", "d")


def test_a_table_has_the_schema_it_has_now(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    spark.range(3).write.parquet(path)
    assert table(spark, str(tmp_path), "t").columns == ["id"]
    spark.range(3).withColumn("more", F.lit(1)).write.mode("overwrite").parquet(path)
    assert table(spark, str(tmp_path), "t").columns == ["id", "more"]


def test_frozen_frames_go_with_their_scope(spark):
    with frozen_scope(spark) as outer:
        with frozen_scope(spark) as inner:
            gone, kept = freeze(spark.range(3), "gone"), freeze(spark.range(4), "kept")
            paths = [Path(df.inputFiles()[0].removeprefix("file:").replace("//", "/")) for df in (gone, kept)]
            inner.keep(kept)
        assert kept.count() == 4 and not paths[0].exists() and paths[1].exists()
        assert len(outer.paths) == 1
    assert not paths[1].exists()


def test_a_failing_gate_writes_nothing(spark, tmp_path):
    bad = spark.createDataFrame([(i, -1.0 if i < 3 else 5.0, 1) for i in range(10)], "customer_id int, monthly_charges double, tenure int")
    with pytest.raises(ValidationError):
        runs.gate(bad)
    report = runs.churn_run(spark, lambda: bad, f"{tmp_path}/out", "now")
    assert report.status == "FAILED"
    # Nothing is published: no log, no staged rows, no reports.
    assert not [p for p in (tmp_path / "out").rglob("*") if p.is_file()]


def test_quantiles_equal_numpy(spark, monkeypatch):
    rng = random.Random(3)
    data = [(i, rng.random() * 100, rng.randrange(5)) for i in range(1_001)]
    df = spark.createDataFrame(data, "id bigint, a double, b int")
    for few, bins in ((digits.FEW, digits.BINS), (3, 4)):  # by values at once, and by many narrow passes
        monkeypatch.setattr(digits, "FEW", few)
        monkeypatch.setattr(digits, "BINS", bins)
        got = digits.quantiles(df, ["a", "b"], {"p25": 0.25, "p50": 0.5, "p90": 0.9})
        for row, place in zip(got, (1, 2)):
            values = [r[place] for r in data]
            assert np.allclose([row["p25"], row["p50"], row["p90"]], np.quantile(values, [0.25, 0.5, 0.9]), rtol=1e-14)


def test_order_statistics_of_extreme_values(spark, monkeypatch):
    monkeypatch.setattr(digits, "FEW", 2)
    monkeypatch.setattr(digits, "BINS", 8)
    values = [-1.7e308, 1.7e308, 5e-324, -5e-324, 0.0, 1.0, 1.0 + 2**-52, 3.0, 3.0, 3.0, 3.0, 1e9, None, 1e-3]
    longs = [-(1 << 63), (1 << 63) - 1, (1 << 63) - 2, 0, 7, 7, 7, 1 << 60, (1 << 60) + 1, -5, None, 3, 2, 1]
    df = spark.createDataFrame(list(zip(values, longs)), "d double, l bigint")
    for name, mine in (("d", values), ("l", longs)):
        held = sorted(v for v in mine if v is not None)
        lanes = {name: F.col(name)}
        found = digits.order_statistics(df, lanes, {name: [*range(0, 20)]}, digits.spans_of(df, lanes))[name]
        assert {p: s.value for p, s in found.items()} == {i + 1: v for i, v in enumerate(held)}
        assert all(s.below == sum(v < s.value for v in held) for s in found.values())
    assert digits.quantiles(df.filter("d > 1e9 and d < 2"), ["d"], {"p50": 0.5}) == []
    nan = spark.createDataFrame([(float("nan"),), (2.0,), (4.0,)], "d double")
    assert digits.quantiles(nan, ["d"], {"p50": 0.5}) == [{"column": "d", "p50": 3.0}]


def test_tiles_equal_a_window(spark, monkeypatch):
    monkeypatch.setattr(digits, "FEW", 5)
    monkeypatch.setattr(digits, "BINS", 16)
    rng = random.Random(4)
    for n in (0, 1, 3, 4, 61, 200):
        # A third of the rows share one value, some have none.
        data = [(i * 7, rng.choice([500, 500, rng.randrange(1000), rng.randrange(1000), None])) for i in range(n)]
        df = spark.createDataFrame(data, "k bigint, v bigint")
        for tiles in (4, 5):
            want = df.withColumn("t", F.ntile(tiles).over(Window.orderBy(F.col("v").asc_nulls_first(), "k")))
            got = df.withColumn("t", digits.tile_of(df, "v", "k", tiles))
            assert rows(got, "k", "t") == rows(want, "k", "t")


def test_quartiles_move_no_rows(spark, base):
    from churnlake.sources.subscriptions import subscriptions

    df = subscriptions(spark, base, "customer_id", "monthly_charges", "churn")
    plan = windows.ntile_quartiles(df, "customer_id")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Window" not in plan and plan.count("Exchange") == 1


def test_a_run_computes_its_source_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(i):
        read.add(1)
        return i

    ident = F.udf(counted, "int").asNondeterministic()
    columns = "customer_id int, contract string, payment_method string, tenure int, monthly_charges double, churn int"
    data = [(i, "One year", "Mailed check", i % 60, 10.0 + i, i % 2) for i in range(100)]
    good = spark.createDataFrame(data, columns).withColumn("customer_id", ident("customer_id"))
    report = runs.churn_run(spark, lambda: good, f"{tmp_path}/out", "now")
    assert report.status == "SUCCESS", report.errors
    assert read.value == 100
    assert report.metrics["executive_summary"]["total_churned"] == 50 and report.metrics["data_quality"] == "ALL PASSED"
    assert versions.read_current(spark, f"{tmp_path}/out/enriched").count() == 100
    # A run that fails the gate changes nothing that readers see, and leaves no staged rows.
    bad = good.withColumn("monthly_charges", F.lit(-1.0))
    again = runs.churn_run(spark, lambda: bad, f"{tmp_path}/out", "later")
    assert again.status == "FAILED" and "100 of 100" in again.errors[0]
    assert versions.read_current(spark, f"{tmp_path}/out/enriched").count() == 100
    assert len([p for p in (tmp_path / "out" / "enriched").iterdir() if p.name.startswith("data-")]) == 1


def test_a_source_that_fails_half_way_is_left_out(spark, tmp_path):
    def broken():
        return spark.range(10).withColumn("x", F.raise_error(F.lit("torn")).cast("string"))

    sources = {"good": lambda: spark.range(7), "torn": broken}
    frames, report = runs.multi_source_ingest(spark, sources, str(tmp_path))
    assert {r["source"]: (r["status"], r["rows"]) for r in report.collect()} == {"good": ("SUCCESS", 7), "torn": ("WARNING", None)}
    assert list(frames) == ["good"] and frames["good"].count() == 7


def test_running_sum_includes_ties(spark):
    data = [(i, i % 7, i) for i in range(50)] + [(50, None, 1)]
    out = ordering.running_sum(spark.createDataFrame(data, "id int, k int, v int"), "k", "desc", "v", "s")
    expected = [
        (i, sum(v for _, other, v in data if k is None or (other is not None and other >= k))) for i, k, _ in data
    ]
    assert rows(out, "id", "s") == sorted(expected, key=str)


def test_band_edges(spark):
    df = spark.createDataFrame([(0,), (35,), (65,), (90,), (200,), (201,), (-1,)], "v int")
    right = ladders.bin_right_closed(F.col("v"), scoring.CHARGE_EDGES, scoring.CHARGE_LABELS)
    left = ladders.bin_left_closed(F.col("v"), scoring.CHARGE_EDGES[1:4], scoring.CHARGE_LABELS)
    low, mid, high, top = scoring.CHARGE_LABELS
    got = {r[0]: (r[1], r[2]) for r in df.select("v", right, left).collect()}
    assert got[0] == (low, low) and got[201] == (None, top) and got[-1] == (None, low)
    assert got[35] == (low, mid) and got[65] == (mid, high) and got[90] == (high, top) and got[200] == (top, top)


def test_open_low_bins_drop_zero_and_beyond(spark):
    df = spark.createDataFrame([(0, 1), (1, 0), (12, 1), (72, 0), (73, 1)], "tenure int, churn int")
    assert rows(aggregates.bin_open_low(df)) == [("0-12", 2, 50.0), ("61-72", 1, 0.0)]


@pytest.mark.parametrize(
    "tenure, points", [(0, 3), (12, 3), (13, 2), (24, 2), (25, 1), (48, 1), (49, 0)]
)
def test_tenure_points(spark, tenure, points):
    df = spark.createDataFrame([(tenure,)], "tenure int")
    assert df.select(scoring.tenure_points()).first()[0] == points


def test_unknown_and_null_contract(spark):
    df = subs(spark, [(1, None, "Electronic check", 1, 10, 0), (2, "Weekly", "Mailed check", 30, 10, 1)])
    out = df.select(
        "customer_id",
        scoring.risk_score_full().alias("full"),
        scoring.risk_score_null_contract().alias("nullable"),
        scoring.risk_label_742(scoring.risk_score_null_contract()).alias("label"),
    )
    assert rows(out) == [(1, 6, None, "🟢 Low"), (2, 3, None, "🟢 Low")]


def test_risk_level_of_the_view(spark):
    m2m, check = "Month-to-month", "Electronic check"
    df = subs(
        spark,
        [(1, m2m, check, 12, 1, 0), (2, m2m, check, 13, 1, 0), (3, m2m, "Mailed check", 1, 1, 0), (4, "One year", check, 1, 1, 0)],
    )
    assert rows(df.select("customer_id", scoring.risk_level_view())) == [(1, "Critical"), (2, "High"), (3, "High"), (4, "Low")]


def test_lookup_risk_with_a_null_side(spark):
    df = spark.createDataFrame([("High", None), (None, None), ("High", "High"), ("Low", "High")], "a string, b string")
    got = [r[0] for r in df.select(scoring.lookup_risk_label(F.col("a"), F.col("b"))).collect()]
    assert got == ["Elevated", "Low", "Critical", "Elevated"]


def test_safe_arithmetic(spark):
    df = spark.createDataFrame([("10", "2"), ("10", "0"), ("x", "1"), (None, "1")], "a string, b string")
    assert [r[0] for r in df.select(numbers.safe_divide("a", "b")).collect()] == [5.0, None, None, None]
    assert [r[0] for r in df.select(numbers.safe_cast("a", "int")).collect()] == [10, 10, None, None]


def test_half_up_rounding(spark):
    df = spark.createDataFrame([(Decimal("1.00"),), (Decimal("1.01"),)], "v decimal(18,2)")
    assert df.agg(numbers.mean("v")).first()[0] == 1.01
    rate = df.agg(numbers.percent(F.lit(1), F.lit(8), 1)).first()[0]
    assert rate == 12.5 and df.agg(numbers.percent(F.lit(1), F.lit(0))).first()[0] is None


def test_title_case(spark):
    df = spark.createDataFrame([("o'neil-smith",), ("HR",), ("éva jo3n",), ("",)], "s string")
    assert [r[0] for r in df.select(text.title_case("s")).collect()] == ["O'Neil-Smith", "Hr", "Éva Jo3N", ""]


def test_not_in_with_nulls(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert rows(joins.anti_join(left, spark.createDataFrame([(2,)], "m int"), "k", "m")) == [(1,)]
    assert rows(joins.anti_join(left, spark.createDataFrame([(2,), (None,)], "m int"), "k", "m")) == []
    assert len(rows(joins.anti_join(left, spark.createDataFrame([], "m int"), "k", "m"))) == 3


def test_duplicates_counted_two_ways(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (2,), (3,)], "k int")
    assert rows(quality.duplicate_summary(df, "k")) == [(2, 3)]


def test_quality_of_bad_and_of_no_rows(spark):
    df = subs(spark, [(None, "a", "b", -1, 0, 2), (1, "a", "b", 1, 5, 0), (1, "a", "b", 1, 5, 1)])
    row = quality.quality_checks(df, "customer_id", quality.customer_rules()).first()
    assert row.asDict() == {
        "total_records": 3, "null_ids": 1, "invalid_charges": 1, "invalid_tenure": 1, "invalid_churn": 1,
        "duplicate_ids": 1, "surplus_rows": 1, "all_passed": False,
    }
    empty = quality.quality_checks(df.filter("tenure > 99"), "customer_id", quality.customer_rules()).first()
    assert empty["total_records"] == 0 and empty["all_passed"]


def test_gate(spark):
    df = spark.createDataFrame([(i, "bad" if i < 4 else None) for i in range(100)], "i int, reason string")
    assert quality.validation_gate(df)["invalid_records"] == 4
    with pytest.raises(quality.ValidationError):
        quality.validation_gate(df.filter("i < 20"))
    with pytest.raises(quality.ValidationError, match="No records"):
        quality.validation_gate(df.filter("i < 0"))


def test_upsert_keeps_the_last_of_repeated_updates(spark):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, at int")
    updates = spark.createDataFrame([(2, "x", 1), (2, "y", 3), (2, "z", 2), (3, "n", 1)], "k int, v string, at int")
    assert rows(warehouse.upsert_by_key(target, updates, "k", ["at"])) == [(1, "a", 0), (2, "y", 3), (3, "n", 1)]


def test_delete_and_update_with_null_predicate(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "k int, v int")
    assert rows(warehouse.delete_where(df, F.col("v") > 10)) == [(1, 5), (2, None)]
    assert rows(warehouse.update_where(df, F.col("v") > 10, {"v": F.lit(0)})) == [(1, 5), (2, None), (3, 0)]


def test_insert_new_only_ignores_null_and_known_keys(spark):
    target = spark.createDataFrame([(1, 9.0)], "k int, charge double")
    staged = warehouse.staging_insert(spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 0.0), (None, 5.0)], "k int, charge double"), "now")
    out = warehouse.insert_new_only(target, staged, "k", F.col("charge") > 0)
    assert rows(out) == [(1, 9.0), (2, 5.0)]
    assert rows(warehouse.mark_processed(staged, out, "k"), "k", "is_processed") == [(1, 1), (2, 1), (3, 0), (None, 0)]


def test_versions(spark, tmp_path):
    root = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, root)
    assert versions.publish(spark, root, versions.stage(spark.range(3), root)) == 1
    old = versions.read_current(spark, root)
    staged = versions.stage(old.filter("id > 0"), root)
    assert versions.read_current(spark, root).count() == 3
    assert versions.publish(spark, root, staged) == 2
    assert (versions.read_current(spark, root).count(), old.count()) == (2, 3)


def test_moving_average_and_empty_input(spark):
    df = subs(spark, [(i, "a", "b", t, 10, c) for i, (t, c) in enumerate([(0, 1), (0, 0), (1, 0), (2, 1), (3, 0), (40, 1)])])
    out = rows(windows.moving_average(df, 36), "tenure", "churn_rate", "moving_avg_churn", "cumulative_customers")
    assert out == [(0, 50.0, 50.0, 2), (1, 0.0, 25.0, 3), (2, 100.0, 50.0, 4), (3, 0.0, 33.3, 5)]
    assert windows.moving_average(df.filter("tenure > 99"), 36).count() == 0
    row = aggregates.executive_summary(df.filter("tenure > 99")).first()
    assert row["total_customers"] == 0 and row["churn_rate_pct"] is None


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 0), (2.0, 1), (4.0, 1)], "v double, churn int")
    assert rows(aggregates.histogram(df, "v", 2, "churn")) == [(0, 1, 2), (1, 1, 1), (1, 2, 1)]


def test_vs_group_mean_with_null_group(spark):
    df = spark.createDataFrame([("a", Decimal(1)), ("a", Decimal(3)), (None, Decimal(5))], "g string, v decimal(18,2)")
    got = windows.with_group_mean(df, "g", "v", "m").select("g", F.col("m").cast("double"))
    assert rows(got) == [("a", 2.0), ("a", 2.0), (None, 5.0)]


def test_union_keeps_rows_of_two_segments(spark):
    df = spark.createDataFrame([(1,), (5,)], "v int")
    parts = {"small": F.col("v") < 6, "odd": F.col("v") == 5}
    assert rows(relational.union_all_segments(df, parts)) == [("odd", 5), ("small", 1), ("small", 5)]
    assert relational.union_all_count(df, list(parts.values()), "n").first()[0] == 3


def test_sample_is_repeatable(spark):
    df = spark.range(1000)
    a = rows(relational.sample_rows(df, "id", 5, 42))
    assert a == rows(relational.sample_rows(df.repartition(7), "id", 5, 42)) and len(a) == 5
    assert a != rows(relational.sample_rows(df, "id", 5, 43))


def test_attach_constants_without_a_row(spark):
    out = joins.attach_constants(spark.range(2), spark.createDataFrame([], "x int"), {"c": "x"})
    assert rows(out) == [(0, None), (1, None)]


def test_calendar(spark):
    df = calendar.dim_date_years(spark)
    assert df.count() == 36
    assert tuple(df.orderBy("date_key").first()) == (202301, 2023, 1, 1, "Jan", 1)


def test_run_reports_its_failure(spark, tmp_path):
    def broken():
        raise ValueError("no source")

    report = runs.churn_run(spark, broken, str(tmp_path), "now")
    assert (report.status, report.stages, report.errors) == ("FAILED", [], ["no source"])


def test_csv_header_is_checked(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        source.read_csv_schema(spark, str(path), "a int, b int").collect()
    inferred = source.read_csv_inferred(spark, str(path))
    assert [f.dataType.simpleString() for f in inferred.schema] == ["int", "int"]


def test_tolerant_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b,c\n1,"two\nlines",3\n4,five\n')
    got = source.read_csv_tolerant(spark, str(path), "a int, b string, c int")
    assert [(r["a"], r["b"], r["c"]) for r in got.orderBy("a").collect()] == [(1, "two\nlines", 3), (4, "five", None)]


def test_schema_from_sample(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("Customer ID,Charge,Churn,Note\n1,2.5,true,x\n")
    schema = source.schema_from_sample(spark, str(path))
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [
        ("customer_id", "int"), ("charge", "double"), ("churn", "string"), ("note", "string"),
    ]


def test_inventory_and_latest(spark, tmp_path):
    import os

    for i, name in enumerate(["raw/a.csv", "raw/x/b.csv", "out/c.csv", "out/d.txt"]):
        f = tmp_path / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text("k\n" + "1\n" * i)
        os.utime(f, (1_000_000 + i * 100, 1_000_000 + i * 100))
    assert rows(source.lake_inventory(spark, str(tmp_path)), "folder", "objects", "bytes") == [("out", 2, 14), ("raw", 2, 6)]
    assert source.latest_file(spark, str(tmp_path)).endswith("out/c.csv")
    assert source.read_all_under_prefix(spark, str(tmp_path), "k int").count() == 3


def test_single_file_and_drops_of_many_files(spark, tmp_path):
    df = spark.range(200_000).repartition(4)
    sink.write_single_file(df, str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    sink.write_csv(df, str(tmp_path / "drops" / "a"))
    sink.write_csv(df.filter("id < 150000"), str(tmp_path / "drops" / "b"))
    newest = source.latest_drop(spark, str(tmp_path / "drops"))
    assert newest.endswith("/b") and source.read_csv_schema(spark, newest, "id bigint").count() == 150_000


def test_json_documents(spark, tmp_path):
    path = tmp_path / "w.json"
    path.write_text('{"source": "s", "total": 2,\n "cities": [{"city": "Accra", "code": 55}, {"city": "Kumasi", "code": 3}]}')
    got = source.read_json_documents(spark, str(path), "cities")
    assert rows(got, "doc_source", "city", "code") == [("s", "Accra", 55), ("s", "Kumasi", 3)]
    labels = got.orderBy("city").select(scoring.weather_condition(F.col("code")))
    assert [r[0] for r in labels.collect()] == ["Rainy 🌧️", "Cloudy ⛅"]


def test_country_report(spark):
    """Profile, newest value, ratios and weather of the published country rows."""
    payload = """{"name": {"common": "Ghana", "official": "Republic of Ghana"}, "capital": ["Accra"], "population": 33742380, "area": 238533.0,
        "region": "Africa", "subregion": "Western Africa", "currencies": {"GHS": {"name": "Ghanaian cedi"}}, "languages": {"eng": "English"}, "timezones": ["UTC"]}"""
    bare = '{"name": {"common": "X", "official": "X"}, "population": 10, "region": "R", "currencies": {}}'
    raw = spark.createDataFrame([(payload,), (bare,)], "p string").select(F.from_json("p", docs.COUNTRY_SCHEMA.replace("\n", " ")).alias("c")).select("c.*")
    flat = docs.json_flatten(raw)
    x = flat.filter("name = 'X'").first()
    assert (x["capital"], x["area_km2"], x["currency_code"], x["currency_name"], x["languages"]) == ("N/A", 0.0, "N/A", "N/A", "")
    pair = '[{"page": 1}, [{"date": "2024", "value": 82308110386.4641}, {"date": "2023", "value": 80547146878.3843}, {"date": "2022", "value": null}, {"date": "2021", "value": 0}]]'
    gdp = docs.json_unnest_filter(spark.createDataFrame([("GH", "Ghana", pair)], "code string, name string, p string"), "p", "code", "name")
    assert rows(gdp, "year", "gdp_billions") == [(2023, 80.55), (2024, 82.31)]
    latest = windows.latest_per_key(gdp.withColumnRenamed("country_name", "name"), "name", ["year"], "year", "gdp_billions")
    weather = spark.createDataFrame(
        [("Accra", "Ghana", 24.0, 96, 53), ("Kumasi", "Ghana", 23.1, 97, 53), ("Tamale", "Ghana", 24.6, 96, 3), ("Cape Coast", "Ghana", 23.2, 97, 81), ("Takoradi", "Ghana", 24.8, 95, 81)],
        "city string, country string, temperature_c double, humidity_pct int, weather_code int",
    )
    summary = docs.weather_summary(docs.with_rain_flag(weather))
    row = docs.unit_ratios(joins.merge_reference_data(flat, latest, summary)).filter("name = 'Ghana'").first()
    assert (row["year"], row["gdp_per_capita_usd"], row["pop_density_per_km2"]) == (2024, 2439.37, 141.46)
    assert (row["cities_monitored"], row["avg_temp_c"], row["avg_humidity_pct"], row["cities_raining"]) == (5, 23.94, 96.2, 4)


def test_documents_of_odd_shapes_are_kept(spark, tmp_path):
    from churnlake.sources import documents

    lines = [
        '{"name": {"common": "A", "official": "Aland"}, "capital": ["X", "Y"], "population": 5, "area": 1.5, "currencies": {"AA": {"name": "a"}}, "languages": {"l": "one", "m": "two"}, "timezones": ["UTC"]}',
        '{"name": "B", "capital": "X", "population": "7", "area": "2", "currencies": {"BB": "b"}, "timezones": "UTC"}',
        '{"name": {"common": "C"}, "capital": [], "population": "many", "area": {}, "currencies": [1], "languages": ["x"]}',
        "[1, 2]",
        "not json",
    ]
    (tmp_path / "d.json").write_text("\n".join(lines) + "\n")
    out = documents.variant_flatten(documents.read_variants(spark, str(tmp_path)))
    want = [
        ("A", "X", 5, 1.5, "AA", "a", "one, two", "UTC"),
        ("B", "X", 7, 2.0, "BB", "b", "", "UTC"),
        ("C", "N/A", None, 0.0, "N/A", "N/A", "", "N/A"),
        (None, "N/A", None, 0.0, "N/A", "N/A", "", "N/A"),
        (None, "N/A", None, 0.0, "N/A", "N/A", "", "N/A"),
    ]
    columns = ["name", "capital", "population", "area_km2", "currency_code", "currency_name", "languages", "timezones"]
    assert rows(out, *columns) == sorted(want, key=str)


def test_payloads_are_parsed_once_in_any_shape(spark):
    from churnlake.sources import documents

    payloads = [
        ("a", '[{"page": 1}, [{"date": "2001", "value": 5e9}, {"date": "2002", "value": null}, {"date": "2003", "value": 0}, {"date": "x", "value": "7000000000"}]]'),
        ("b", '[{"page": 1}, {"message": "none"}]'), ("c", '[{"page": 1}]'), ("d", "torn ["), ("e", None), ("f", '[1, [2, [3], {"value": 1e9}]]'),
    ]
    df = spark.createDataFrame([(c, c, p) for c, p in payloads], "code string, name string, payload string")
    out = documents.json_unnest_filter(df, "payload", "code", "name")
    got = rows(out, "country_code", "year", "gdp_billions")
    assert got == sorted([("a", 2001, 5.0), ("a", None, 7.0), ("f", None, 1.0)], key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json(") == 1 or plan.lower().count("parsejson") == 1


def test_surrogate_keys_survive_later_loads(spark):
    schema = "a string, b string, c int"
    first = warehouse.dim_insert_ignore(spark.createDataFrame([("m", "x", 2), ("b", None, 1), ("m", "x", 1)], schema), ["a", "b"], ["c"], "key")
    first = freeze(first)
    assert rows(first) == [(1, "b", None, 1), (2, "m", "x", 1)]
    later = spark.createDataFrame([("a", "a", 5), ("m", "x", 0), ("b", None, 9), (None, "z", 4), ("a", "a", 3)], schema)
    second = freeze(warehouse.dim_load(first, later, ["a", "b"], ["c"], "key"))
    assert rows(second) == sorted([(1, "b", None, 1), (2, "m", "x", 1), (3, None, "z", 4), (4, "a", "a", 3)], key=str)
    assert rows(warehouse.dim_load(second, later, ["a", "b"], ["c"], "key")) == rows(second)
    none = warehouse.dim_load(first.limit(0), later.limit(0), ["a", "b"], ["c"], "key")
    assert none.count() == 0
