"""Invariants on the generated tables (SURVEY test strategy, point 3)."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from shopgauge.operators import growth, segments, tags
from shopgauge.plans import params as P
from shopgauge.sources.tables import ShopTables

SF = "/root/testdata/sf0.01"


def test_user_tags_one_row_per_member(spark):
    df = E.queries()["user_tags"](spark, SF)
    members = spark.read.parquet(f"{SF}/customer.parquet").count()
    assert df.count() == members
    assert df.select("memberId").distinct().count() == members


def test_literal_table_repeats_only_for_free_coupons(spark):
    t = ShopTables.of(spark, SF)
    lit = E.queries()["user_tags_literal"](spark, SF)
    extra = (t.coupon_member.filter("coupon_id = 1").groupBy("member_id").count()
             .agg(F.sum(F.col("count") - 1)).first()[0])
    members = spark.read.parquet(f"{SF}/customer.parquet").count()
    assert lit.count() == members + extra


def test_growth_calendar_totals_never_decrease(spark):
    rows = E.queries()["growth_calendar"](spark, SF).collect()
    assert len(rows) == 7
    for a, b in zip(rows, rows[1:]):
        assert a.day < b.day
        assert a.memberCount <= b.memberCount and a.orderCount <= b.orderCount
        assert a.gmv <= b.gmv


def test_literal_equals_exact_when_orders_have_one_line(spark):
    t = ShopTables.of(spark, SF)
    single = (t.order_commodity.groupBy("order_id").count().filter("count = 1")
              .select("order_id"))
    orders = t.order.join(single, "order_id", "left_semi")
    lines = t.order_commodity.join(single, "order_id", "left_semi")
    lit = tags.tag_order_behavior(orders, lines)
    exact = tags.tag_order_behavior_exact(orders, lines)
    assert lit.count() > 0
    assert lit.exceptAll(exact).count() == 0 and exact.exceptAll(lit).count() == 0


def test_segment_batch_restricted_equals_select_without_limit(spark):
    t = ShopTables.of(spark, SF)
    ut = tags.user_tags(t.member, t.order, t.order_commodity, t.coupon_member, t.coupon,
                        t.delivery, t.feedback)
    for seg_id, conds in P.SEGMENT_BATCH.items():
        batch = (segments.segment_batch(ut, P.SEGMENT_BATCH)
                 .filter(F.col("segment_id") == seg_id).select("memberId"))
        one = segments.segment_members(ut, conds).select("memberId")
        assert batch.exceptAll(one).count() == 0 and one.exceptAll(batch).count() == 0


def test_wow_daily_sums_match_compare(spark):
    t = ShopTables.of(spark, SF)
    daily = growth.wow_order_daily(t.order, P.WOW_ORDER_AS_OF).agg(F.sum("orderCount")).first()[0]
    cmp_ = growth.wow_order_compare(t.order, P.WOW_ORDER_AS_OF).agg(
        F.sum(F.col("n") + F.col("prev_n"))).first()[0]
    assert daily == cmp_
