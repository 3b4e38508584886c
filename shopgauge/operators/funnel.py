"""Conversion funnel: present -> click -> add to cart -> order -> order again -> charge coupon."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import CHARGE_CHANNEL, FUNNEL_TOP_STEPS, PLACED_STATUS

# The shop data has no page views, clicks or cart adds: those steps take given numbers.
DEFAULT_TOP_STEPS = FUNNEL_TOP_STEPS


def repeat_buyers(order: DataFrame, order_status: int = PLACED_STATUS) -> DataFrame:
    """Members with more than one placed order (a NULL member forms one group of its own)."""
    return (order.filter(F.col("order_status") == order_status)
            .groupBy("member_id").agg(F.count("order_id").alias("orderCount"))
            .filter(F.col("orderCount") > 1)
            .select("member_id"))


STEPS = ["present", "click", "addCart", "order", "orderAgain", "chargeCoupon"]


# Event type counted for each of the first steps when an event table is given (None: no event
# records that step, so its given number is kept).
STEP_EVENTS = {"present": "view", "click": "click", "addCart": None}


def _event_steps(events: DataFrame, step_events: dict[str, str | None]) -> DataFrame:
    """One row: distinct users per step event type (one pass over the events)."""
    return events.agg(*[
        F.count_distinct(F.when(F.col("event_type") == kind, F.col("user_id"))).alias(step)
        for step, kind in step_events.items() if kind])


def funnel_counts(order: DataFrame, coupon_member: DataFrame, order_status: int = PLACED_STATUS,
                  charge_channel: int = CHARGE_CHANNEL, top_steps: dict[str, int] | None = None,
                  with_rates: bool = False, events: DataFrame | None = None,
                  step_events: dict[str, str | None] | None = None) -> DataFrame:
    """One row: present, click, addCart, order, orderAgain, chargeCoupon (all LONG).

    order       = distinct members with a placed order (NULL counts as one value, as a
                  `select distinct` does);
    orderAgain  = of those, members with more than one placed order;
    chargeCoupon= repeat buyers who also bought a coupon on the charge channel (an equi-join,
                  so a NULL member never matches).

    One job: orders are grouped per member once (partial aggregation before the shuffle), the
    charged members are de-duplicated per member, the two member-keyed frames are joined on
    the member key (co-partitioned), and one global aggregate produces the row.
    """
    steps = dict(DEFAULT_TOP_STEPS, **(top_steps or {}))
    per_member = (order.filter(F.col("order_status") == order_status)
                  .groupBy("member_id").agg(F.count("order_id").alias("n")))
    charged = (coupon_member.filter(F.col("coupon_channel") == charge_channel)
               .filter(F.col("member_id").isNotNull())
               .select("member_id").distinct()
               .withColumn("charged", F.lit(True)))
    flagged = per_member.join(charged, "member_id", "left")
    again = F.col("n") > 1
    counts = flagged.agg(
        F.lit(steps["present"]).cast("bigint").alias("present"),
        F.lit(steps["click"]).cast("bigint").alias("click"),
        F.lit(steps["addCart"]).cast("bigint").alias("addCart"),
        F.count(F.lit(1)).alias("order"),
        F.count_if(again).alias("orderAgain"),
        F.count_if(again & F.coalesce(F.col("charged"), F.lit(False))).alias("chargeCoupon"))
    if events is not None:
        # Replace the given numbers by distinct users per event type: the event row and the
        # count row are unioned and folded by one global aggregate (no join).
        from_events = _event_steps(events, step_events or STEP_EVENTS)
        measured = set(from_events.columns)
        filler = counts.select(*[F.lit(None).cast("bigint").alias(c) if c in measured
                                 else F.col(c) for c in STEPS])
        extra = from_events.select(*[F.col(c) if c in measured
                                     else F.lit(None).cast("bigint").alias(c) for c in STEPS])
        counts = filler.unionByName(extra).agg(*[F.max(c).alias(c) for c in STEPS])
    if not with_rates:
        return counts
    # Step-to-step conversion: each step over the one before it (NULL when that one is 0).
    return counts.select("*", *[
        F.try_divide(F.col(b).cast("double"), F.col(a)).alias(f"{b}Rate")
        for a, b in zip(STEPS, STEPS[1:])])
