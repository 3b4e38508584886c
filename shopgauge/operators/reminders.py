"""Marketing reminders: coupons granted per day over the last week.

The first-order-free coupon has id 1; every other id is a voucher. The day is taken from the
grant time by default (the column is a parameter, so an expiry column can be used instead).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import FREE_COUPON_ID, FREE_REMIND_CHANNEL
from .daily import as_date, daily_counts


def remind_free_daily(coupon_member: DataFrame, as_of, days: int = 7,
                      time_col: str = "create_time") -> DataFrame:
    lower = as_date(as_of) - dt.timedelta(days=days)
    free = coupon_member.filter((F.col("coupon_id") == FREE_COUPON_ID)
                                & (F.col("coupon_channel") == FREE_REMIND_CHANNEL))
    return daily_counts(free, time_col, "member_id", "freeCount", lower, None)


def remind_coupon_daily(coupon_member: DataFrame, as_of, days: int = 7,
                        time_col: str = "create_time") -> DataFrame:
    lower = as_date(as_of) - dt.timedelta(days=days)
    vouchers = coupon_member.filter(F.col("coupon_id") != FREE_COUPON_ID)
    return daily_counts(vouchers, time_col, "member_id", "couponCount", lower, None)
