"""Every registered query against DuckDB on the given tables."""

import pytest
from compare import differences

from __spark_entry__ import entry, oracle_sql, queries
from churnlake import queries as bound
from churnlake.queries.registry import ORACLES, QUERIES

bound.load()
# A query whose answer SQL cannot give: sizes of written files.
ROWS_ONLY = {"lake_inventory"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, base, con, name):
    df = QUERIES[name](spark, base)
    assert differences(df, con, ORACLES[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert slow not in plan


def test_only_the_named_queries_have_no_oracle():
    assert QUERIES.keys() - ORACLES.keys() == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_query_runs(spark, base, name):
    assert QUERIES[name](spark, base).count() > 0


def test_entry_runs(spark):
    assert entry(spark).count() == 3


def test_the_entry_file_has_all_queries():
    assert queries().keys() >= QUERIES.keys() and oracle_sql().keys() >= ORACLES.keys()
