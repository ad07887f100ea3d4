"""Plan shape: no Python in the hot path, filters reach the scan, no cartesian products."""

import pytest

import __spark_entry__ as E
from memberlens.plans.registry import QUERIES
from tests.conftest import SF_SMALL

PLAN_QUERIES = [n for n in QUERIES if not n.startswith("cdc_ods") and n != "cdc_partition_commit"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAN_QUERIES)
def test_no_python_udf_no_cartesian(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "FlatMapGroupsInPandas"):
        assert bad not in p, (name, bad)


def test_time_filter_pushed_into_scan(spark):
    p = plan(E.queries()["wow_order"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p


def test_tag_build_prunes_columns(spark):
    p = plan(E.queries()["user_tag_member"](spark, SF_SMALL))
    # the lineitem scan reads only the two columns the goods tag needs
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in p


def test_line_grain_tags_read_each_table_once(spark):
    p = plan(E.queries()["tag_order_behavior"](spark, SF_SMALL))
    assert p.count("l_orderkey:bigint") == 1 and p.count("o_orderkey:bigint") == 1


def test_top_k_is_not_a_global_sort(spark):
    p = plan(E.queries()["hot_words"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_coupon_dimension_is_broadcast_when_small(spark):
    p = plan(E.queries()["tag_charge_money"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p


def test_aggregates_are_partial_before_the_shuffle(spark):
    # With broadcasts off (the shape at scale) every shuffle of the tag build
    # is fed by a partial aggregate or is the member-keyed join input.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(E.queries()["user_tag_member"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert p.count("partial_") >= 5 or p.count("HashAggregate") >= 10
    # no collect over raw order lines: the only list aggregates are per member
    assert "collect_set" not in p


def test_bulk_segments_join_on_keys(spark):
    """Whatever the sizes: equi joins only, and plans that are built without a call per rule."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("segment_bulk", "tag_counts"):
            p = plan(E.queries()[name](spark, SF_SMALL))
            assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_row_crosses_are_broadcast_even_without_estimates(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("member_heat", "member_overview"):
            p = plan(E.queries()[name](spark, SF_SMALL))
            assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" in p, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
