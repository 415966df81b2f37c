"""Plan shape: the properties that matter at scale are asserted on the
physical plans of registered queries."""

import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
Q = entry.queries()
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="no test data")


def plan_of(spark, name):
    df = Q[name](spark, SF)
    df.collect()                      # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_event_sequence_pushes_the_match(spark):
    p = plan_of(spark, "p7_event_sequence")
    assert "EqualTo(user_id,17)" in p and "Exchange" not in p.split("Initial Plan")[0]


@pytest.mark.parametrize("name", ["j4_range_join", "j12_interval_conflicts", "j18_cidr_match"])
def test_range_joins_are_equi_joins(spark, name):
    p = plan_of(spark, name)
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_top_k_per_group_limits_before_the_shuffle(spark):
    p = plan_of(spark, "w9_rank_hits")
    assert "WindowGroupLimit" in p


def test_summary_scan_is_pruned(spark):
    p = plan_of(spark, "a5_summary")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p
    assert "LessThan(ts,2024-01-28T00:00)" in p


def test_ledger_pivot_is_one_aggregation(spark):
    p = plan_of(spark, "g2_from_ledger").split("Initial Plan")[0]
    assert p.count("Exchange hashpartitioning") == 1
