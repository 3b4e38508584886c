"""Platform growth (line chart) and week-over-week comparison (bar chart).

Running totals are computed over day-level rows only: the raw rows are first reduced to one row
per day (partial aggregation before the shuffle), so the ordered window that follows sees at
most one row per calendar day plus one "before the window" row, whatever the data size.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .daily import as_date, calendar, daily_counts, day_label, time_window, ts_literal

MONEY_SUM = "decimal(38,2)"
# Sorts before every yyyy-MM-dd label: the bucket of rows older than the window.
PRIOR = ""


def running(col: str) -> F.Column:
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(col).over(w)


def growth_daily(member: DataFrame, order: DataFrame, as_of, days: int = 7,
                 until=None) -> DataFrame:
    """Growth per day since `as_of - days`, as the report defines it.

    day, regCount (new members that day), memberCount (largest member id that day),
    orderCount (largest order id that day), gmv (money of all orders before the window plus the
    running sum of the daily money). Days are those with both a registration and an order
    (the inner join of the two daily reports); a day missing on either side is dropped and its
    money is not added to later totals. No upper bound unless `until` is given.

    One aggregate over member rows and order rows keyed by day (orders before the window in a
    single PRIOR bucket) replaces the two daily reports, their join and the prior-sum query;
    the running window then sees one row per kept day.
    """
    as_of = as_date(as_of)
    lower = as_of - dt.timedelta(days=days)
    upper = as_date(until) if until is not None else None
    nothing = F.lit(None)
    regs = time_window(member, "create_time", lower, upper).select(
        day_label("create_time").alias("day"), F.col("id").alias("mid"),
        nothing.cast("bigint").alias("oid"), nothing.cast(MONEY_SUM).alias("money"),
        F.lit(True).alias("is_reg"))
    in_window = F.col("create_time") >= ts_literal(lower, order, "create_time")
    # An order without a time belongs to no day and to no total.
    dated = order.filter(F.col("create_time").isNotNull())
    orders = time_window(dated, "create_time", None, upper).select(
        F.when(in_window, day_label("create_time")).otherwise(F.lit(PRIOR)).alias("day"),
        nothing.cast("bigint").alias("mid"), F.col("order_id").alias("oid"),
        F.col("origin_price").cast(MONEY_SUM).alias("money"), F.lit(False).alias("is_reg"))
    per_day = (regs.unionByName(orders).groupBy("day")
               .agg(F.count("mid").alias("regCount"), F.max("mid").alias("memberCount"),
                    F.max("oid").alias("orderCount"),
                    F.sum("money").cast(MONEY_SUM).alias("day_gmv"),
                    F.count_if(F.col("is_reg")).alias("n_reg"),
                    F.count_if(~F.col("is_reg")).alias("n_order")))
    kept = per_day.filter((F.col("day") == PRIOR)
                          | ((F.col("n_reg") > 0) & (F.col("n_order") > 0)))
    return (kept.withColumn("gmv", F.coalesce(running("day_gmv"), F.lit(0)).cast("double"))
            .filter(F.col("day") != PRIOR)
            .select("day", "regCount", "memberCount", "orderCount", "gmv")
            .orderBy("day"))


def growth_calendar(member: DataFrame, order: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Every one of the `days` complete days before `as_of`, with true running totals.

    regCount = members registered that day; memberCount / orderCount / gmv = members, orders
    and order money up to the end of that day. One aggregate over member rows, order rows (both
    with the upper bound pushed to the scan; rows before the window in a single PRIOR bucket)
    and the calendar's zero rows; the running window then sees at most `days` + 1 rows.
    """
    as_of = as_date(as_of)
    lower = as_of - dt.timedelta(days=days)

    def bucket(df: DataFrame) -> F.Column:
        return (F.when(F.col("create_time") >= ts_literal(lower, df, "create_time"),
                       day_label("create_time"))
                .otherwise(F.lit(PRIOR)).alias("day"))

    zero = F.lit(0).cast("bigint")
    no_money = F.lit(0).cast(MONEY_SUM)
    regs = time_window(member, "create_time", None, as_of).select(
        bucket(member), F.col("id").isNotNull().cast("bigint").alias("reg"), zero.alias("ord"),
        no_money.alias("money"))
    orders = time_window(order, "create_time", None, as_of).select(
        bucket(order), zero.alias("reg"), F.col("order_id").isNotNull().cast("bigint").alias("ord"),
        F.coalesce(F.col("origin_price").cast(MONEY_SUM), no_money).alias("money"))
    cal = (calendar(member, lower, as_of - dt.timedelta(days=1))
           .select("day", zero.alias("reg"), zero.alias("ord"), no_money.alias("money")))
    per_day = (regs.unionByName(orders).unionByName(cal)
               .groupBy("day")
               .agg(F.sum("reg").alias("reg"), F.sum("ord").alias("ord"),
                    F.sum("money").cast(MONEY_SUM).alias("money")))
    return (per_day
            .select("day", F.col("reg").alias("regCount"),
                    running("reg").alias("memberCount"),
                    running("ord").alias("orderCount"),
                    running("money").cast("double").alias("gmv"))
            .filter(F.col("day") != PRIOR)
            .orderBy("day"))


def wow_daily(df: DataFrame, ts: str, count_col: str, out: str, as_of, days: int = 14) -> DataFrame:
    """Counts per day over the `days` days before `as_of` (half-open window)."""
    as_of = as_date(as_of)
    return daily_counts(df, ts, count_col, out, as_of - dt.timedelta(days=days), as_of)


def wow_reg_daily(member: DataFrame, as_of) -> DataFrame:
    return wow_daily(member, "create_time", "id", "regCount", as_of)


def wow_order_daily(order: DataFrame, as_of) -> DataFrame:
    return wow_daily(order, "create_time", "order_id", "orderCount", as_of)


def week_compare(df: DataFrame, ts: str, count_col: str, as_of) -> DataFrame:
    """Each day of the last week against the same weekday of the week before.

    day, weekday (ISO 1 = Monday), n, prev_n, wow = (n - prev_n) / prev_n (NULL when prev_n = 0).
    One aggregate: every row of the two weeks is keyed by the day of the last week it compares
    to, and counted into `n` or `prev_n`; empty days come from a 7-row calendar.
    """
    as_of = as_date(as_of)
    week_start = as_of - dt.timedelta(days=7)
    cur = F.col(ts) >= ts_literal(week_start, df, ts)
    target = F.when(cur, F.col(ts)).otherwise(F.col(ts) + F.expr("interval 7 days"))
    counts = (time_window(df, ts, as_of - dt.timedelta(days=14), as_of)
              .groupBy(day_label(target).alias("day"))
              .agg(F.count(F.when(cur, F.col(count_col))).alias("n"),
                   F.count(F.when(~cur, F.col(count_col))).alias("prev_n")))
    cal = calendar(df, week_start, as_of - dt.timedelta(days=1))
    joined = cal.join(counts, "day", "left").fillna(0, subset=["n", "prev_n"])
    return joined.select(
        "day",
        (F.weekday(F.to_date("day")) + 1).alias("weekday"),
        "n", "prev_n",
        F.try_divide((F.col("n") - F.col("prev_n")).cast("double"), F.col("prev_n")).alias("wow"))


def wow_reg_compare(member: DataFrame, as_of) -> DataFrame:
    return week_compare(member, "create_time", "id", as_of)


def wow_order_compare(order: DataFrame, as_of) -> DataFrame:
    return week_compare(order, "create_time", "order_id", as_of)
