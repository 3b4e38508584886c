"""Anchor values worked out independently for the adapter views (FIXTURES section 4)."""

import pytest

import __spark_entry__ as E

S1, S2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def first(spark, name, sf):
    return E.queries()[name](spark, sf).first().asDict()


@pytest.mark.parametrize("sf,expected", [(S1, (145, 123, 12)), (S2, (1429, 1256, 121))])
def test_funnel(spark, sf, expected):
    got = first(spark, "funnel_counts", sf)
    assert (got["order"], got["orderAgain"], got["chargeCoupon"]) == expected


@pytest.mark.parametrize("sf,expected", [(S1, (100, 50)), (S2, (1000, 500))])
def test_subscription(spark, sf, expected):
    got = first(spark, "member_mp_sub", sf)
    assert (got["subCount"], got["unsubCount"]) == expected


def test_heat(spark):
    assert first(spark, "member_heat", S2) == {"coupon": 150, "reg": 122, "complete": 1378,
                                                "order": 2, "orderAgain": 1498}


@pytest.mark.parametrize("name,sf,rows", [
    ("member_channel", S2, 25), ("member_sex", S1, 5), ("member_sex", S2, 5),
    ("remind_free_daily", S1, 8), ("remind_free_daily", S2, 8),
    ("remind_coupon_daily", S1, 8), ("remind_coupon_daily", S2, 8),
    ("wow_reg_daily", S1, 7), ("wow_reg_daily", S2, 14), ("wow_order_daily", S2, 14),
    ("tag_order_behavior", S1, 150), ("tag_order_behavior", S2, 1500),
    ("tag_charge_money", S1, 15), ("tag_charge_money", S2, 150),
    ("tag_over_time", S1, 150), ("tag_over_time", S2, 1500),
    ("tag_latest_feedback", S1, 15), ("tag_latest_feedback", S2, 150),
    ("user_tags_literal", S2, 3367), ("user_tags", S2, 1500)])
def test_row_counts(spark, name, sf, rows):
    assert E.queries()[name](spark, sf).count() == rows


@pytest.mark.parametrize("sf,count,money,charge", [(S1, 41, 9579842.04, 5859.05),
                                                   (S2, 49, 10266033.08, 3615.70)])
def test_member_zero(spark, sf, count, money, charge):
    ob = E.queries()["tag_order_behavior"](spark, sf).filter("memberId = 0").first()
    assert (ob.orderCount, ob.orderMoney) == (count, money)
    cm = E.queries()["tag_charge_money"](spark, sf).filter("memberId = 0").first()
    assert cm.chargeMoney == pytest.approx(charge, abs=1e-9)
