"""Builders for small shop tables (edge rows the driver's tables lack)."""

import datetime as dt
from decimal import Decimal

MEMBER = ("id bigint, phone string, sex string, member_channel int, mp_open_id string, "
          "address_default_id int, create_time timestamp_ntz")
ORDER = ("order_id bigint, member_id bigint, order_status int, origin_price decimal(18,2), "
         "pay_price decimal(18,2), create_time timestamp_ntz")
ORDER_COMMODITY = "order_id bigint, commodity_id bigint"
COUPON = "id bigint, coupon_price decimal(18,2)"
COUPON_MEMBER = "member_id bigint, coupon_id bigint, coupon_channel bigint, create_time timestamp_ntz"
DELIVERY = "member_id bigint, pick_time timestamp_ntz, arrive_time timestamp_ntz"
FEEDBACK = "id bigint, member_id bigint, feedback_type bigint"


def ts(text):
    return dt.datetime.fromisoformat(text)


def money(x):
    return Decimal(str(x)).quantize(Decimal("0.01"))


def member(mid, phone="p", sex="M", channel=1, sub="s", address=1, created="2019-11-01"):
    return (mid, phone, sex, channel, sub, address, ts(created) if created else None)


def order(oid, mid, status=2, price=10, created="2019-11-01"):
    return (oid, mid, status, money(price), money(price), ts(created))


def frames(spark, members=(), orders=(), lines=(), coupons=(), grants=(), deliveries=(),
           feedback=()):
    return dict(
        member=spark.createDataFrame(list(members), MEMBER),
        order=spark.createDataFrame(list(orders), ORDER),
        order_commodity=spark.createDataFrame(list(lines), ORDER_COMMODITY),
        coupon=spark.createDataFrame(list(coupons), COUPON),
        coupon_member=spark.createDataFrame(list(grants), COUPON_MEMBER),
        delivery=spark.createDataFrame(list(deliveries), DELIVERY),
        feedback=spark.createDataFrame(list(feedback), FEEDBACK),
    )
