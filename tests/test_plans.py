"""Plan shape: pushed filters, bounded top-k, no Cartesian products, no shuffle in segments."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["user_tags", "user_tags_literal", "member_heat",
                                  "member_profile_json", "funnel_counts", "growth_daily",
                                  "growth_calendar"])
def test_no_cartesian_or_nested_loop(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["hot_field_top10", "hot_tokens_top10"])
def test_top_k_is_bounded(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


# (Registration time is a derived minimum, so its filter stays above the aggregate.)
@pytest.mark.parametrize("name,column", [("wow_order_daily", "o_orderdate"),
                                         ("remind_free_daily", "ts"),
                                         ("growth_calendar", "o_orderdate")])
def test_time_filters_reach_the_scan(spark, name, column):
    text = plan(spark, name)
    assert f"LessThan({column}" in text or f"GreaterThanOrEqual({column}" in text


def test_projection_is_pruned(spark):
    text = plan(spark, "member_sex")
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in text


def test_segment_batch_adds_no_shuffle_over_user_tags(spark):
    tags_plan = plan(spark, "user_tags")
    batch_plan = plan(spark, "segment_batch")
    # Tag sides no condition reads are even pruned away by the optimizer.
    assert batch_plan.count("Exchange") <= tags_plan.count("Exchange")


def test_order_goods_deduplicated_before_collect(spark):
    text = plan(spark, "tag_order_behavior_exact")
    # (member, commodity) pairs are de-duplicated by a hash aggregate before collect_list.
    assert "HashAggregate(keys=[member_id" in text and "collect_list" in text


def test_user_tags_static_shape_when_every_side_is_large(spark):
    """With no broadcast and no AQE (the shape at scale): each exchange belongs to an aggregate
    or a raw-table join, the member-keyed join chain adds none, the event table is read twice."""
    from shopgauge.operators import tags
    from shopgauge.sources.tables import ShopTables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        t = ShopTables(spark, SF)
        df = tags.user_tags(t.member, t.order, t.order_commodity, t.coupon_member, t.coupon,
                            t.delivery, t.feedback)
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # The figures of the raw orders have an aggregate of their own, before the list of goods.
    assert text.count("Exchange hashpartitioning") <= 15
    assert text.count("events.parquet") <= 2
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_no_object_aggregate_over_raw_orders(spark):
    """Only aggregated figures and distinct goods reach the aggregate that gathers lists."""
    text = plan(spark, "tag_order_behavior_exact")
    before = text[text.index("Union"):]
    assert "ObjectHashAggregate" not in before and "ObjectHashAggregate" in text


@pytest.mark.parametrize("name", ["hot_tokens_top10", "date_normalize", "date_shift", "date_parts"])
def test_no_round_robin_of_raw_rows(spark, name):
    assert "RoundRobinPartitioning" not in plan(spark, name)


def test_literal_order_tags_read_lines_and_orders_once(spark):
    text = plan(spark, "tag_order_behavior")
    assert text.count("struct<l_orderkey") == 1 and text.count("struct<o_orderkey") == 1
