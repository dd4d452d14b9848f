"""Physical plans: what is read, what is shuffled, what is broadcast."""

import re

from pyspark.sql import functions as F

from churnlake.operators import aggregates, windows
from churnlake.sinks import files as sink
from churnlake.sources.subscriptions import subscriptions

from __spark_entry__ import queries

QUERIES = queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_unused_tables_are_not_read(spark, base):
    text = plan(subscriptions(spark, base, "contract", "monthly_charges"))
    assert "lineitem" not in text and "customer.parquet" not in text and "Join" not in text
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in text


def test_lines_are_pruned_and_summed_before_the_shuffle(spark, base):
    text = plan(subscriptions(spark, base, "customer_id", "churn"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_returnflag:string>" in text
    assert re.search(r"Exchange hashpartitioning\(l_orderkey.*?\n.*?HashAggregate.*?partial_sum", text, re.S)


def test_rank_filter_limits_groups_before_the_shuffle(spark, base):
    df = subscriptions(spark, base, "contract", "customer_id", "tenure")
    for out in (
        windows.top_n_per_group(df, "contract", [("tenure", "desc"), ("customer_id", "asc")], 3, "r"),
        windows.rank_top_with_ties(df, "contract", [("tenure", "desc")], 3, "r"),
        windows.rank_then_filter(df, "contract", [("tenure", "desc")], 3, F.col("tenure") > 1, "r"),
    ):
        text = plan(out)
        assert "WindowGroupLimit" in text and "Partial" in text


def test_group_mean_uses_no_window(spark, base):
    text = plan(windows.vs_partition_avg(subscriptions(spark, base, "customer_id", "contract", "monthly_charges", "churn")))
    assert "Window" not in text and "BroadcastHashJoin" in text


def test_lookups_are_broadcast_by_their_size(spark, base):
    text = plan(QUERIES["multi_join_enrich"](spark, base))
    assert text.count("LocalTableScan") == 3 and "SortMergeJoin [contract" not in text
    assert text.count("BroadcastHashJoin") >= 3


def test_top_k_is_not_a_full_sort(spark, base):
    assert "TakeOrderedAndProject" in plan(QUERIES["action_753"](spark, base))


def test_segments_come_from_one_scan(spark, base):
    assert plan(QUERIES["union_all_segments"](spark, base)).count("orders.parquet") == 1
    assert plan(QUERIES["concat_frames"](spark, base)).count("orders.parquet") == 1


def test_layout_prunes_folders_and_pushes_filters(spark, base, tmp_path):
    df = subscriptions(spark, base, "customer_id", "contract", "churn", "monthly_charges", "tenure")
    sink.layout_for_filters(df, str(tmp_path), "contract", ["churn", "monthly_charges"])
    text = plan(spark.read.parquet(str(tmp_path)).filter("contract = 'One year' and churn = 1 and monthly_charges >= 390000"))
    assert re.search(r"PartitionFilters: \[.*contract", text)
    assert "EqualTo(churn,1)" in text and "GreaterThanOrEqual(monthly_charg" in text


def test_quality_reads_its_table_once(spark, base):
    assert plan(QUERIES["quality_checks_failing"](spark, base)).count("FileScan") == 1


def test_profile_is_one_pass(spark, base):
    assert plan(aggregates.profile_columns(subscriptions(spark, base, "contract", "tenure"))).count("FileScan") == 1


def test_stored_buckets_are_joined_without_a_shuffle(spark, base, tmp_path):
    from churnlake.sources.subscriptions import store_bucketed

    store_bucketed(spark, base, "plan_test", str(tmp_path), 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = subscriptions(spark, base, "contract", "monthly_charges", "churn", stored="plan_test")
        text = plan(aggregates.churn_by(rows, ["contract"], ["total", "churned"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in text and "orderkey" not in "".join(x for x in text.splitlines() if "Exchange" in x)
    assert text.count("Exchange") == 2  # of the partial sums by contract, and of their order


def test_a_filter_on_a_dimension_prunes_the_fact(spark, base):
    df = QUERIES["star_query_pruned"](spark, base)
    assert "dynamicpruning" in plan(df)
    df.collect()
    ran = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(plan_key" in ran
    read = len({r[0] for r in df.sparkSession.read.parquet(df.inputFiles()[0].rsplit("/plan_key=", 1)[0]).select("plan_key").distinct().collect()})
    scans = [s for s in _scans(df._jdf.queryExecution().executedPlan()) if "plan_key" in s[0] and "is_churned" in s[0]]
    assert scans and all(parts < read for _, parts in scans)


def _scans(node):
    """Description and number of folders read of every file scan of an executed plan."""
    out, todo = [], [node]
    while todo:
        n = todo.pop()
        name = n.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(n.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(n.plan())
            continue
        if name == "FileSourceScanExec":
            metric = n.metrics().get("numPartitions")
            if metric.isDefined():
                out.append((n.toString(), metric.get().value()))
        children = n.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out
