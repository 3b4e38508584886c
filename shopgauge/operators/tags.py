"""User tags (member profile): one wide row per member built from orders, coupons, deliveries
and feedback, plus the per-source tag frames it is joined from.

Scale notes
* Every tag side is aggregated on `memberId` before the wide join, so each join is member-sized
  and keyed by the same column: the sides arrive hash-partitioned on `memberId` and the chain of
  left joins needs no further shuffle of the growing left side. AQE turns a side into a
  broadcast only when its measured size is under the broadcast threshold.
* Arrays are gathered only after de-duplication by (member, value) or (member, day) in an
  ordinary hash aggregate, so a member holding a third of all rows is spread over many tasks
  until the very last step, which only sees that member's distinct values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import CHARGE_CHANNEL, FREE_COUPON_ID
from .daily import day_label

MONEY_SUM = "decimal(38,2)"
# Largest number of repeated rows generated from one array in the literal wide table.
REPEAT_CHUNK = 4096
# Free-coupon grants of one member from which the chunks of its rows are dealt over tasks.
SPREAD_FROM = 1_000_000

BASE_COLUMNS = ["memberId", "phone", "sex", "channel", "subOpenId", "address", "regTime"]
TAG_COLUMNS = BASE_COLUMNS + ["orderCount", "orderTime", "orderMoney", "favGoods",
                              "freeCouponTime", "couponTimes", "chargeMoney", "overTime",
                              "feedBack"]


def tag_member_base(member: DataFrame) -> DataFrame:
    return member.select(F.col("id").alias("memberId"), "phone", "sex",
                         F.col("member_channel").alias("channel"),
                         F.col("mp_open_id").alias("subOpenId"),
                         F.col("address_default_id").alias("address"),
                         day_label("create_time").alias("regTime"))


def _member_goods(order: DataFrame, order_commodity: DataFrame) -> DataFrame:
    """member_id, commodity_id: distinct goods over all lines of each member's orders."""
    o = order.select("order_id", "member_id")
    lines = order_commodity.select("order_id", "commodity_id").filter(
        F.col("commodity_id").isNotNull())
    return (o.join(lines, "order_id", "inner")
            .select("member_id", "commodity_id").distinct())


def order_tags(rows: DataFrame, goods: DataFrame) -> DataFrame:
    """Order figures per member from order rows (member_id, order_id, w, money, create_time) and
    the member's distinct goods (member_id, commodity_id).

    Sums and maxima over the raw orders are a hash aggregate in generated code; only its one row
    per member and the already distinct goods meet in the aggregate that gathers the list. The
    union needs no join, so a member without any line gets an empty list and a null member its own.
    """
    figures = (rows.groupBy("member_id")
               .agg(F.sum(F.when(F.col("order_id").isNotNull(), F.col("w"))).alias("orderCount"),
                    F.max("create_time").alias("last"), F.sum("money").alias("money")))
    both = figures.unionByName(goods, allowMissingColumns=True)
    return (both.groupBy(F.col("member_id").alias("memberId"))
            .agg(F.coalesce(F.max("orderCount"), F.lit(0).cast("bigint")).alias("orderCount"),
                 day_label(F.max("last")).alias("orderTime"),
                 F.max("money").cast(MONEY_SUM).cast("double").alias("orderMoney"),
                 F.sort_array(F.collect_list("commodity_id")).alias("favGoods")))


def tag_order_behavior(order: DataFrame, order_commodity: DataFrame) -> DataFrame:
    """Order behaviour as the tag job defines it: orders are joined to their lines first, so an
    order with k lines counts k times in orderCount and orderMoney (an order with no line counts
    once). orderTime = day of the last order; favGoods = distinct goods ([] if none).

    The fan-out is not materialised, and orders and lines are each read once: lines are counted per
    (order, good) with map-side partial counts, so an order that holds a third of all lines costs
    each map task its distinct goods. Every order meets its counted goods in one left join (AQE's
    skew join splits a hot order), and the result is summed per (member, good), partially again,
    before a member gathers one row for each good.
    """
    counted = (order_commodity.groupBy("order_id", "commodity_id")
               .agg(F.count(F.lit(1)).alias("k")))
    weight = F.coalesce(F.col("k"), F.lit(1))
    per_good = (order.select("member_id", "order_id", "create_time", "pay_price")
                .join(counted, "order_id", "left")
                .groupBy("member_id", "commodity_id")
                .agg(F.sum(F.when(F.col("order_id").isNotNull(), weight)).alias("orders"),
                     F.max("create_time").alias("last"),
                     F.sum((F.col("pay_price") * weight).cast(MONEY_SUM)).alias("money")))
    return (per_good.groupBy(F.col("member_id").alias("memberId"))
            .agg(F.coalesce(F.sum("orders"), F.lit(0).cast("bigint")).alias("orderCount"),
                 day_label(F.max("last")).alias("orderTime"),
                 F.sum("money").cast(MONEY_SUM).cast("double").alias("orderMoney"),
                 F.sort_array(F.collect_list("commodity_id")).alias("favGoods")))


def tag_order_behavior_exact(order: DataFrame, order_commodity: DataFrame) -> DataFrame:
    """Order behaviour at order level: each order counts once, whatever its number of lines."""
    rows = order.select("member_id", "order_id", "create_time",
                        F.lit(1).cast("bigint").alias("w"),
                        F.col("pay_price").cast(MONEY_SUM).alias("money"))
    return order_tags(rows, _member_goods(order, order_commodity))


def tag_free_coupon(coupon_member: DataFrame) -> DataFrame:
    """One row per first-order-free coupon grant (a member may appear more than once)."""
    return (coupon_member.filter(F.col("coupon_id") == FREE_COUPON_ID)
            .select(F.col("member_id").alias("memberId"),
                    day_label("create_time").alias("freeCouponTime")))


def _repeated(days: str) -> Column:
    """A sorted list of (day, n) as the list of days, each n times."""
    return F.flatten(F.transform(days, lambda x: F.array_repeat(x["day"], x["n"].cast("int"))))


def _gathered(n: str) -> Column:
    """The (day, n) pairs of a member's rows with a day and a count, in day order."""
    return F.sort_array(F.collect_list(F.when(
        F.col("day").isNotNull() & (F.col(n) > 0), F.struct(F.col("day"), F.col(n).alias("n")))))


def tag_coupon_times(coupon_member: DataFrame) -> DataFrame:
    """memberId, couponTimes: the day of every voucher grant, repeats kept, in day order (a grant
    without a time has no day to list; a member with such grants only has an empty list).

    Grants are first counted per (member, day); each member then gathers at most one entry per
    distinct day and expands it back to the repeated list in a row-local expression.
    """
    per_day = (coupon_member.filter(F.col("coupon_id") != FREE_COUPON_ID)
               .groupBy(F.col("member_id").alias("memberId"),
                        day_label("create_time").alias("day"))
               .agg(F.count(F.lit(1)).alias("n")))
    return (per_day.groupBy("memberId").agg(_gathered("n").alias("days"))
            .select("memberId", _repeated("days").alias("couponTimes")))


def _price_sums(coupon: DataFrame) -> DataFrame:
    """One row per coupon id: a price listed twice counts twice, but doubles no grant."""
    return coupon.groupBy(F.col("id").alias("coupon_id")).agg(
        F.sum("coupon_price").alias("coupon_price"))


def tag_charge_money(coupon_member: DataFrame, coupon: DataFrame) -> DataFrame:
    """memberId, chargeMoney = half the price of every coupon bought outside the charge channel.

    Grants are counted per (member, coupon) on the map side before they look their price up, so
    a coupon that holds most grants meets the price table as one row per member. A coupon missing
    from the price table adds nothing (NULL when the member has no priced one).
    """
    grants = (coupon_member.filter(F.col("coupon_channel") != CHARGE_CHANNEL)
              .groupBy("member_id", "coupon_id").agg(F.count(F.lit(1)).alias("n")))
    priced = grants.join(_price_sums(coupon), "coupon_id", "left")
    return (priced.groupBy(F.col("member_id").alias("memberId"))
            .agg((F.sum(F.col("coupon_price") * F.col("n")).cast(MONEY_SUM).cast("double") / 2)
                 .alias("chargeMoney")))


def tag_over_time(delivery: DataFrame) -> DataFrame:
    """memberId, overTime = latest arrival minus latest pick-up, in seconds (each maximum is taken
    over all the member's deliveries on its own)."""
    return (delivery.groupBy(F.col("member_id").alias("memberId"))
            .agg((F.unix_timestamp(F.max("arrive_time"))
                  - F.unix_timestamp(F.max("pick_time"))).alias("overTime")))


def tag_latest_feedback(feedback: DataFrame) -> DataFrame:
    """memberId, feedBack = type of the member's feedback with the largest id (one aggregate)."""
    return (feedback.groupBy(F.col("member_id").alias("memberId"))
            .agg(F.max_by("feedback_type", "id").alias("feedBack")))


def _coupon_tags(coupon_member: DataFrame, coupon: DataFrame) -> DataFrame:
    """memberId, freeCouponTime (earliest), free_days, couponTimes, chargeMoney in one pipeline.

    The grant table is read once and counted per (member, day, coupon) on the map side before
    prices are looked up; then one member aggregate gathers its counted days. Same values as
    `tag_coupon_times` and `tag_charge_money` (a tag a member has no grant for is NULL).
    """
    free = F.col("coupon_id") == FREE_COUPON_ID
    voucher = F.col("coupon_id") != FREE_COUPON_ID
    grants = (coupon_member.groupBy("member_id", day_label("create_time").alias("day"), "coupon_id")
              .agg(F.count_if(free).alias("n_free"), F.count_if(voucher).alias("n_voucher"),
                   F.count_if(F.col("coupon_channel") != CHARGE_CHANNEL).alias("n_charged"),
                   F.min(F.when(free, F.col("create_time"))).alias("first_free")))
    return coupon_tags(grants, coupon)


def coupon_tags(grants: DataFrame, coupon: DataFrame) -> DataFrame:
    """The coupon tags of grants counted by (member_id, day, coupon_id): n_free, n_voucher,
    n_charged and first_free, the time of the first free one."""
    priced = grants.join(_price_sums(coupon), "coupon_id", "left")
    money = F.when(F.col("n_charged") > 0, F.col("coupon_price") * F.col("n_charged"))
    return (priced.groupBy(F.col("member_id").alias("memberId"))
            .agg(day_label(F.min("first_free")).alias("freeCouponTime"),
                 F.sort_array(F.collect_list(F.when(F.col("n_free") > 0, F.struct(
                     F.col("day"), F.col("n_free").alias("n"))))).alias("free_days"),
                 F.sum("n_voucher").alias("vouchers"), _gathered("n_voucher").alias("days"),
                 (F.sum(money).cast(MONEY_SUM).cast("double") / 2).alias("chargeMoney"))
            .select("memberId", "freeCouponTime", "free_days",
                    F.when(F.col("vouchers") > 0, _repeated("days")).alias("couponTimes"),
                    "chargeMoney"))


def wide(base: DataFrame, order_side: DataFrame, coupon_side: DataFrame,
         over_time: DataFrame, feedback: DataFrame, literal: bool = False,
         spread: bool = False) -> DataFrame:
    """The member rows with all tags beside them (each side has one row per member).

    `literal` repeats a row per free coupon; `spread` deals the repeats over tasks in chunks.
    """
    joined = base
    for side in (order_side, coupon_side, over_time, feedback):
        joined = joined.join(side, "memberId", "left")
    if literal:
        # One row per free-coupon grant (one row when the member has none), re-expanded only
        # after the last join: the joins see one row per member, the repeats are generated in
        # place and never shuffled. The expansion runs in two bounded steps (chunk ids, then at
        # most REPEAT_CHUNK copies each), so no array ever holds a hot member's whole count.
        n = F.coalesce(F.col("_free.n"), F.lit(1)).cast("long")
        chunk = F.lit(REPEAT_CHUNK).cast("long")
        joined = (joined.withColumn("_free", F.explode_outer("free_days"))
                  .withColumn("freeCouponTime", F.col("_free.day"))
                  .withColumn("_chunk", F.explode(F.sequence(
                      F.lit(0).cast("long"), F.floor((n - 1) / chunk).cast("long")))))
        if spread:
            tasks = int(joined.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            joined = joined.repartition(tasks, "memberId", "freeCouponTime", "_chunk")
        joined = (joined.withColumn("_rep", F.explode(F.array_repeat(
                      F.lit(True), F.least(chunk, n - F.col("_chunk") * chunk).cast("int")))))
    return joined.select(*TAG_COLUMNS)


def user_tags_literal(member: DataFrame, order: DataFrame, order_commodity: DataFrame,
                      coupon_member: DataFrame, coupon: DataFrame, delivery: DataFrame,
                      feedback: DataFrame, spread: bool | None = None) -> DataFrame:
    """The wide tag table exactly as the tag job joins it: line fan-out in the order tags and one
    row per free-coupon grant (members with several grants repeat).

    A member with SPREAD_FROM grants or more has its repeats generated by many tasks. Whether there
    is one is counted first (one small aggregate over the free grants), unless `spread` says so.
    """
    if spread is None:
        most = (coupon_member.filter(F.col("coupon_id") == FREE_COUPON_ID)
                .groupBy("member_id").count().agg(F.max("count")).first()[0])
        spread = (most or 0) >= SPREAD_FROM
    return wide(tag_member_base(member), tag_order_behavior(order, order_commodity),
                _coupon_tags(coupon_member, coupon), tag_over_time(delivery),
                tag_latest_feedback(feedback), literal=True, spread=spread)


def user_tags(member: DataFrame, order: DataFrame, order_commodity: DataFrame,
              coupon_member: DataFrame, coupon: DataFrame, delivery: DataFrame,
              feedback: DataFrame) -> DataFrame:
    """The wide tag table with one row per member: order-level counts and money, and the
    earliest free-coupon day."""
    return wide(tag_member_base(member), tag_order_behavior_exact(order, order_commodity),
                _coupon_tags(coupon_member, coupon), tag_over_time(delivery),
                tag_latest_feedback(feedback))
