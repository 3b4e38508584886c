"""A hot member holding a third of all orders and coupon grants (derived from the test tables):
the tag table stays correct (checked against plain counting over the collected rows)."""

from collections import Counter, defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from shopgauge.operators import funnel, tags
from shopgauge.sources.tables import ShopTables

SF = "/root/testdata/sf0.01"
HOT = 1


def _skewed(spark):
    t = ShopTables(spark, SF)
    order = t.order.withColumn(
        "member_id", F.when(F.col("order_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("member_id")))
    grants = t.coupon_member.withColumn(
        "member_id", F.when(F.hash("create_time") % 3 == 0, F.lit(HOT))
        .otherwise(F.col("member_id")))
    return t, order, grants


def _rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_hot_member_user_tags_match_counting(spark):
    """Every tag of every member, counted row by row in Python."""
    t, order, grants = _skewed(spark)
    count, last, money = Counter(), {}, defaultdict(Decimal)
    owner = {}
    for oid, member, at, paid in _rows(order, "order_id", "member_id", "create_time", "pay_price"):
        owner[oid] = member
        count[member] += 1
        last[member] = max(last.get(member, at), at)
        money[member] += paid
    goods = defaultdict(set)
    for oid, good in _rows(t.order_commodity, "order_id", "commodity_id"):
        if oid in owner:
            goods[owner[oid]].add(good)
    price = dict(_rows(t.coupon, "id", "coupon_price"))
    days, charged = defaultdict(list), {}
    for member, coupon, channel, at in _rows(grants, "member_id", "coupon_id", "coupon_channel",
                                             "create_time"):
        if coupon != 1:
            days[member].append(at.date().isoformat())
        if channel != 1 and coupon in price:
            charged[member] = charged.get(member, 0) + price[coupon]
    ours = tags.user_tags(t.member, order, t.order_commodity, grants, t.coupon, t.delivery,
                          t.feedback).collect()
    assert len(ours) == t.member.count()
    for r in ours:
        m = r.memberId
        has = m in count
        assert r.orderCount == (count[m] if has else None)
        assert r.orderTime == (last[m].date().isoformat() if has else None)
        assert r.orderMoney == (float(money[m]) if has else None)
        assert r.favGoods == (sorted(goods[m]) if has else None)
        assert r.couponTimes == (sorted(days[m]) if m in days else None)
        assert r.chargeMoney == (float(charged[m]) / 2 if m in charged else None)
    assert count[HOT] >= sum(count.values()) // 3


def test_hot_member_funnel_and_literal_counts(spark):
    t, order, grants = _skewed(spark)
    got = funnel.funnel_counts(order, grants).first()
    placed = order.filter("order_status = 2")
    assert got["order"] == placed.select("member_id").distinct().count()
    lit = tags.user_tags_literal(t.member, order, t.order_commodity, grants, t.coupon,
                                 t.delivery, t.feedback)
    free = grants.filter("coupon_id = 1").groupBy("member_id").count()
    extra = free.agg(F.sum(F.col("count") - 1)).first()[0]
    assert lit.count() == t.member.count() + extra


def test_hot_order_literal_counts_match_counting(spark):
    """One order holding a third of all lines: the literal fan-out counts stay exact and the
    line counts are combined before the shuffle (no raw repartition of the lines)."""
    t = ShopTables(spark, SF)
    hot_order = t.order.agg(F.min("order_id")).first()[0]
    lines = t.order_commodity.withColumn(
        "order_id", F.when(F.col("commodity_id") % 3 == 0, F.lit(hot_order))
        .otherwise(F.col("order_id")))
    ours = tags.tag_order_behavior(t.order, lines)
    n_lines, goods = Counter(), defaultdict(set)
    for oid, good in _rows(lines, "order_id", "commodity_id"):
        n_lines[oid] += 1
        goods[oid].add(good)
    count, money, fav = Counter(), defaultdict(Decimal), defaultdict(set)
    for oid, member, paid in _rows(t.order, "order_id", "member_id", "pay_price"):
        k = max(1, n_lines[oid])
        count[member] += k
        money[member] += k * paid
        fav[member] |= goods[oid]
    got = {r.memberId: (r.orderCount, r.orderMoney, r.favGoods) for r in ours.collect()}
    assert got == {m: (count[m], float(money[m]), sorted(fav[m])) for m in count}
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" not in plan


def test_repeats_of_a_hot_member_leave_many_tasks(spark, monkeypatch):
    t, order, grants = _skewed(spark)
    args = (t.member, order, t.order_commodity, grants, t.coupon, t.delivery, t.feedback)
    monkeypatch.setattr(tags, "REPEAT_CHUNK", 4)
    plain = tags.user_tags_literal(*args, spread=False)
    monkeypatch.setattr(tags, "SPREAD_FROM", 50)
    dealt = tags.user_tags_literal(*args)
    cols = tags.TAG_COLUMNS
    assert Counter(map(repr, dealt.select(cols).collect())) == Counter(
        map(repr, plain.select(cols).collect()))
    tasks = dealt.filter(F.col("memberId") == HOT).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) > 50
