"""Edge rows the generated tables lack (NULL members, fan-out, missing prices, sentinels...)."""

import datetime as dt
import os
import shutil
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shop_rows import frames, member, money, order, ts
from shopgauge.functions import dates as D
from shopgauge.operators import funnel, growth, members, tags, words
from shopgauge.sources.text import delimited_field


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_e1_subscription_sentinel(spark):
    f = frames(spark, members=[member(1, sub="x"), member(2, sub="null"), member(3, sub=None)])
    assert one(members.member_mp_sub(f["member"])) == {"subCount": 1, "unsubCount": 1}


def test_e2_heat_order_buckets(spark):
    f = frames(spark,
               members=[member(1, phone="null"), member(2), member(3)],
               orders=[order(1, 1), order(2, 2), order(3, 2)],
               grants=[(1, 5, 2, ts("2019-11-01")), (1, 6, 2, ts("2019-11-02")),
                       (None, 6, 2, ts("2019-11-02"))])
    got = one(members.member_heat(f["member"], f["order"], f["coupon_member"]))
    assert got == {"coupon": 1, "reg": 1, "complete": 2, "order": 1, "orderAgain": 1}


def test_e3_e4_funnel_null_member(spark):
    f = frames(spark, orders=[order(1, None), order(2, None), order(3, 7)],
               grants=[(None, 2, 1, ts("2019-11-01"))])
    got = one(funnel.funnel_counts(f["order"], f["coupon_member"]))
    assert (got["order"], got["orderAgain"], got["chargeCoupon"]) == (2, 1, 0)
    assert (got["present"], got["click"], got["addCart"]) == (1000, 800, 600)
    assert [r.member_id for r in funnel.repeat_buyers(f["order"]).collect()] == [None]


def test_funnel_charge_counts_repeat_buyers_only(spark):
    f = frames(spark, orders=[order(1, 7), order(2, 7), order(3, 8)],
               grants=[(7, 2, 1, ts("2019-11-01")), (7, 3, 1, ts("2019-11-02")),
                       (8, 2, 1, ts("2019-11-01"))])
    got = one(funnel.funnel_counts(f["order"], f["coupon_member"]))
    assert (got["order"], got["orderAgain"], got["chargeCoupon"]) == (2, 1, 1)


def _e5(spark):
    return frames(spark, orders=[order(1, 9, price=10, created="2019-11-03")],
                  lines=[(1, 101), (1, 101), (1, 102)])


def test_e5_order_behavior_literal_fan_out(spark):
    f = _e5(spark)
    got = one(tags.tag_order_behavior(f["order"], f["order_commodity"]))
    assert got == {"memberId": 9, "orderCount": 3, "orderTime": "2019-11-03",
                   "orderMoney": 30.0, "favGoods": [101, 102]}


def test_e6_order_behavior_exact(spark):
    f = _e5(spark)
    got = one(tags.tag_order_behavior_exact(f["order"], f["order_commodity"]))
    assert got == {"memberId": 9, "orderCount": 1, "orderTime": "2019-11-03",
                   "orderMoney": 10.0, "favGoods": [101, 102]}


def test_e7_order_without_line(spark):
    f = frames(spark, orders=[order(1, 9)])
    for op in (tags.tag_order_behavior, tags.tag_order_behavior_exact):
        got = one(op(f["order"], f["order_commodity"]))
        assert got["orderCount"] == 1 and got["favGoods"] == []


def test_null_member_orders_keep_their_goods(spark):
    f = frames(spark, orders=[order(1, None), order(2, None)], lines=[(1, 5), (2, 6), (2, 5)])
    got = one(tags.tag_order_behavior_exact(f["order"], f["order_commodity"]))
    assert got["memberId"] is None and got["orderCount"] == 2 and got["favGoods"] == [5, 6]


def _wide_args(f):
    return (f["member"], f["order"], f["order_commodity"], f["coupon_member"], f["coupon"],
            f["delivery"], f["feedback"])


def test_e8_free_coupon_repeats_in_literal_only(spark):
    f = frames(spark, members=[member(1), member(2)],
               grants=[(1, 1, 2, ts("2019-11-05 08:00:00")), (1, 1, 2, ts("2019-11-02"))])
    literal = tags.user_tags_literal(*_wide_args(f)).filter("memberId = 1").collect()
    assert sorted(r.freeCouponTime for r in literal) == ["2019-11-02", "2019-11-05"]
    exact = tags.user_tags(*_wide_args(f)).collect()
    assert len(exact) == 2
    assert [r.freeCouponTime for r in exact if r.memberId == 1] == ["2019-11-02"]


def test_e9_coupon_without_price(spark):
    f = frames(spark, coupons=[(5, money(8))],
               grants=[(1, 99, 2, ts("2019-11-01")), (2, 5, 2, ts("2019-11-01")),
                       (2, 5, 2, ts("2019-11-02")), (2, 99, 2, ts("2019-11-02")),
                       (3, 5, 1, ts("2019-11-01"))])
    got = {r.memberId: r.chargeMoney
           for r in tags.tag_charge_money(f["coupon_member"], f["coupon"]).collect()}
    assert got == {1: None, 2: 8.0}


def test_e10_over_time_takes_maxima_apart(spark):
    f = frames(spark, deliveries=[(1, ts("2019-11-01 10:00:00"), ts("2019-11-01 11:00:00")),
                                  (1, ts("2019-11-01 12:00:00"), None)])
    assert one(tags.tag_over_time(f["delivery"]))["overTime"] == -3600


def test_e11_latest_feedback(spark):
    f = frames(spark, feedback=[(5, 1, 1), (9, 1, 3), (7, 1, 4)])
    assert one(tags.tag_latest_feedback(f["feedback"])) == {"memberId": 1, "feedBack": 3}


def test_coupon_times_keep_repeats_in_day_order(spark):
    f = frames(spark, grants=[(1, 2, 2, ts("2019-11-03")), (1, 3, 2, ts("2019-11-01 09:00:00")),
                              (1, 4, 2, ts("2019-11-03 10:00:00")), (1, 1, 2, ts("2019-11-04"))])
    assert one(tags.tag_coupon_times(f["coupon_member"]))["couponTimes"] == [
        "2019-11-01", "2019-11-03", "2019-11-03"]


def _growth(spark):
    # Registrations on d1, d3; orders on d1, d2, d3; one order before the window.
    return frames(spark,
                  members=[member(1, created="2019-11-01"), member(2, created="2019-11-03"),
                           member(3, created="2019-10-01")],
                  orders=[order(1, 1, price=100, created="2019-10-01"),
                          order(2, 1, price=1, created="2019-11-01"),
                          order(3, 1, price=2, created="2019-11-02"),
                          order(4, 2, price=4, created="2019-11-03")])


def test_e12_growth_literal_drops_days(spark):
    f = _growth(spark)
    got = [r.asDict() for r in growth.growth_daily(f["member"], f["order"], "2019-11-04",
                                                   days=3).collect()]
    assert got == [
        {"day": "2019-11-01", "regCount": 1, "memberCount": 1, "orderCount": 2, "gmv": 101.0},
        {"day": "2019-11-03", "regCount": 1, "memberCount": 2, "orderCount": 4, "gmv": 105.0}]


def test_e13_growth_calendar_keeps_all_days(spark):
    f = _growth(spark)
    got = [r.asDict() for r in growth.growth_calendar(f["member"], f["order"], "2019-11-04",
                                                      days=3).collect()]
    assert got == [
        {"day": "2019-11-01", "regCount": 1, "memberCount": 2, "orderCount": 2, "gmv": 101.0},
        {"day": "2019-11-02", "regCount": 0, "memberCount": 2, "orderCount": 3, "gmv": 103.0},
        {"day": "2019-11-03", "regCount": 1, "memberCount": 3, "orderCount": 4, "gmv": 107.0}]


def test_e14_no_prior_orders(spark):
    f = frames(spark, members=[member(1, created="2019-11-01")],
               orders=[order(1, 1, price=5, created="2019-11-01")])
    got = growth.growth_daily(f["member"], f["order"], "2019-11-02", days=7).collect()
    assert [r.gmv for r in got] == [5.0]


def test_growth_literal_until_bounds_the_window(spark):
    f = _growth(spark)
    got = growth.growth_daily(f["member"], f["order"], "2019-11-04", days=3,
                              until="2019-11-02").collect()
    assert [r.day for r in got] == ["2019-11-01"]


def test_e15_hot_field_lines(spark):
    lines = spark.createDataFrame([("a\tb\tc",), ("a\tb",), ("a\tb\t\td",), ("a\tb\t",),
                                   ("x\ty\tc\t",)], "line string")
    got = {r.word: r["count"] for r in words.hot_field_top(lines, 10).collect()}
    assert got == {"c": 2, "": 1}
    rej = one(words.hot_field_rejects(lines))
    assert rej == {"lines": 5, "rejected": 2}


def test_hot_tokens_ignore_empty_tokens(spark):
    docs = spark.createDataFrame([(" a  b\tb\n",), ("",), ("b c",)], "text string")
    got = [(r.word, r["count"]) for r in words.hot_tokens_top(docs, 2).collect()]
    assert got == [("b", 3), ("a", 1)]


def test_e21_detect_styles(spark):
    df = spark.createDataFrame([("2019-11-30",), ("2019/11/30 10:05",), ("2019年11月30日",),
                                ("10:05",), ("2019-13-45",), (None,), ("abc",),
                                ("2019-11-30 extra",), ("2019-1-3",)], "txt string")
    got = [r.s for r in df.select(D.detect_style("txt").alias("s")).collect()]
    assert got == ["yyyy-MM-dd", "yyyy/MM/dd HH:mm", "yyyy年MM月dd日", "HH:mm",
                   None, None, None, None, None]


def test_every_style_matches_only_itself(spark):
    when = dt.datetime(2019, 11, 30, 10, 5, 7)
    df = spark.createDataFrame([(when,)], "t timestamp_ntz")
    texts = df.select(*[F.date_format("t", p).alias(f"c{i}")
                        for i, p in enumerate(D.PATTERNS)]).first()
    for i, p in enumerate(D.PATTERNS):
        one_df = spark.createDataFrame([(texts[i],)], "txt string")
        assert one_df.select(D.detect_style("txt")).first()[0] == p


def test_e22_interval_days(spark):
    df = spark.createDataFrame([("2019-01-01", "2019-03-01")], "a string, b string")
    assert df.select(D.interval_days(D.parse_date("a"), D.parse_date("b"))).first()[0] == 59


def test_e23_month_and_year_shift_clamp(spark):
    df = spark.createDataFrame([("2020-01-31", "2020-02-29")], "a string, b string")
    row = df.select(D.format_date(D.add_months(D.parse_date("a"), 1), D.DAY).alias("m"),
                    D.format_date(D.add_years(D.parse_date("b"), 1), D.DAY).alias("y")).first()
    assert (row.m, row.y) == ("2020-02-29", "2021-02-28")


def test_shift_text_keeps_style(spark):
    df = spark.createDataFrame([("2019/11/30 23:00",), ("11月30日",), ("23:59:59",)], "txt string")
    got = [r.s for r in df.select(D.shift_text("txt", 1).alias("s")).collect()]
    assert got == ["2019/12/01 23:00", "12月01日", "23:59:59"]


def test_e24_weekday_names(spark):
    df = spark.createDataFrame([("2019-11-30",)], "txt string")
    ts_ = D.parse_date("txt")
    row = df.select(D.weekday_number(ts_), D.weekday_en(ts_), D.weekday_short(ts_),
                    D.weekday_cn(ts_)).first()
    assert tuple(row) == (6, "Saturday", "Sat.", "星期六")


def test_month_is_one_based_with_zero_based_option(spark):
    df = spark.createDataFrame([("2019-11-30",)], "txt string")
    row = df.select(D.month(D.parse_date("txt")), D.month(D.parse_date("txt"), True)).first()
    assert tuple(row) == (11, 10)


def test_e25_week_compare_zero_previous(spark):
    f = frames(spark, members=[member(1, created="2019-11-25"), member(2, created="2019-11-25"),
                               member(3, created="2019-11-18"), member(4, created="2019-11-29")])
    got = {r.day: r.asDict() for r in growth.wow_reg_compare(f["member"], "2019-11-30").collect()}
    assert len(got) == 7
    assert got["2019-11-25"]["n"] == 2 and got["2019-11-25"]["prev_n"] == 1
    assert got["2019-11-25"]["wow"] == pytest.approx(1.0)
    assert got["2019-11-29"]["prev_n"] == 0 and got["2019-11-29"]["wow"] is None
    assert got["2019-11-25"]["weekday"] == 1


def test_funnel_top_steps_from_events(spark):
    f = frames(spark, orders=[order(1, 7), order(2, 7)])
    events = spark.createDataFrame(
        [(1, 7, "view"), (2, 7, "view"), (3, 8, "view"), (4, 8, "click"), (5, 9, "purchase")],
        "event_id bigint, user_id bigint, event_type string")
    got = one(funnel.funnel_counts(f["order"], f["coupon_member"], events=events))
    assert (got["present"], got["click"], got["addCart"]) == (2, 1, 600)
    assert (got["order"], got["orderAgain"], got["chargeCoupon"]) == (1, 1, 0)


def test_literal_repeats_expand_in_bounded_chunks(spark, monkeypatch):
    monkeypatch.setattr(tags, "REPEAT_CHUNK", 3)
    grants = [(1, 1, 2, ts("2019-11-02"))] * 7 + [(1, 1, 2, ts("2019-11-03"))] * 3
    f = frames(spark, members=[member(1), member(2)], grants=grants)
    rows = tags.user_tags_literal(*_wide_args(f)).collect()
    days = sorted(r.freeCouponTime for r in rows if r.memberId == 1)
    assert days == ["2019-11-02"] * 7 + ["2019-11-03"] * 3
    assert [r.freeCouponTime for r in rows if r.memberId == 2] == [None]


def test_orders_without_a_time_enter_no_total(spark):
    """A null order time is in no day and in no prior total."""
    member = spark.createDataFrame([(1, dt.datetime(2021, 5, 5))], "id long, create_time timestamp")
    order = spark.createDataFrame(
        [(1, Decimal(10), dt.datetime(2021, 1, 1)), (2, Decimal(99), None),
         (3, Decimal(5), dt.datetime(2021, 5, 5))],
        "order_id long, origin_price decimal(18,2), create_time timestamp")
    got = growth.growth_daily(member, order, "2021-05-10").collect()
    assert [(r.day, r.gmv) for r in got] == [("2021-05-05", 15.0)]
    whole = growth.growth_calendar(member, order, "2021-05-10").collect()
    assert whole[-1].gmv == 15.0 and whole[-1].orderCount == 2


def _grants(spark, rows):
    return spark.createDataFrame(
        rows, "member_id long, coupon_id long, coupon_channel long, create_time timestamp")


def test_voucher_days_of_undated_grants_and_twice_listed_prices(spark):
    """Undated grants list no day (and give an empty list alone); a price listed twice adds its
    money twice, as the price join says, but no grant day."""
    day = dt.datetime(2019, 11, 1, 8)
    grants = _grants(spark, [(1, 5, 2, day), (1, 5, 2, None), (2, 5, 2, None), (3, 1, 2, day)])
    prices = spark.createDataFrame([(5, Decimal(4)), (5, Decimal(4))],
                                   "id long, coupon_price decimal(18,2)")
    alone = {r.memberId: r.couponTimes for r in tags.tag_coupon_times(grants).collect()}
    wide = {r.memberId: r for r in tags._coupon_tags(grants, prices).collect()}
    assert alone == {1: ["2019-11-01"], 2: []}
    assert {m: r.couponTimes for m, r in wide.items()} == {1: ["2019-11-01"], 2: [], 3: None}
    assert [tuple(x) for x in wide[3].free_days] == [("2019-11-01", 1)]
    assert wide[1].chargeMoney == 8.0


def test_new_files_are_seen_by_the_next_query(spark):
    from shopgauge.plans import queries
    folder = tempfile.mkdtemp(prefix="sg-grow-")
    for name in ("customer", "orders"):
        os.mkdir(f"{folder}/{name}.parquet")
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", f"{folder}/{name}.parquet/a.parquet")
    before = queries()["member_mp_sub"](spark, folder).first()
    shutil.copy("/root/testdata/sf0.001/customer.parquet", f"{folder}/customer.parquet/b.parquet")
    after = queries()["member_mp_sub"](spark, folder).first()
    assert after.subCount == 2 * before.subCount and after.unsubCount == 2 * before.unsubCount


def test_interval_days_reads_text_of_any_style(spark):
    df = spark.createDataFrame([("2019/11/30", "2019年12月02日"), ("bad", "2019-01-01"),
                                (None, "2019-01-01")], "a string, b string")
    got = [r.n for r in df.select(D.interval_days("a", "b").alias("n")).collect()]
    assert got == [2, None, None]


def test_a_line_separator_at_the_end_is_text(spark):
    df = spark.createDataFrame([("a\tb\t\u2028",), ("a\tb\t\t",), ("a\tb\tc\x85",)], "line string")
    got = [r.w for r in df.select(delimited_field("line", 2).alias("w")).collect()]
    assert got == ["\u2028", None, "c\x85"]
