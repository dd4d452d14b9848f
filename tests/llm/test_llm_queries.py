"""Registered queries against DuckDB on the given tables."""

import pytest
from compare import differences

from churnlake.llm.oracles import ORACLES
from churnlake.llm.queries import QUERIES

NO_SQL = {"op4_itq_near_groups", "op6_string_kernel_toxicity", "op9_kd_shards", "op10_piece_encoding"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, base, con, name):
    assert differences(QUERIES[name](spark, base), con, ORACLES[name]) == []


def test_the_others_are_tested_by_brute_force():
    assert QUERIES.keys() - ORACLES.keys() == NO_SQL


def test_native_operators_use_no_python(spark, base):
    for name in ("op5_mix_words", "op9_kd_shards"):
        plan = QUERIES[name](spark, base)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"))
