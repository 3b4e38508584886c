"""Growth reports from a stored rollup of closed days.

The rollup holds one row per day with a registration or an order: the figures that the growth
reports need, however many rows the day had. `close` aggregates the days up to a high-water mark,
reading raw rows behind the former mark only; days for which rows came late are named and
aggregated anew, whole. Months are the partitions, so a run replaces the months that it changes
and reads nothing else. A repeated run writes the same rows.

The reports read the rollup and the raw rows of open days, those behind the mark, and agree with
`growth.growth_daily` and `growth.growth_calendar` over all rows. A row without a time has no day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import written
from .daily import as_date, calendar, day_label, time_window, ts_literal
from .growth import MONEY_SUM, PRIOR, running

SCHEMA = (f"day string, reg_rows long, regs long, max_member long, order_rows long, orders long, "
          f"max_order long, money {MONEY_SUM}, month string")
_SUMS = ("reg_rows", "regs", "order_rows", "orders")


def day_rows(member: DataFrame, order: DataFrame, lower: dt.date | None = None,
             upper: dt.date | None = None, days: list[dt.date] | None = None) -> DataFrame:
    """One row per day of the raw rows with lower <= time < upper, or of the named days."""
    def window(df: DataFrame) -> DataFrame:
        df = time_window(df.filter("create_time is not null"), "create_time", lower, upper)
        if days is None:
            return df
        named = F.lit(False)
        for d in days:
            named = named | ((F.col("create_time") >= ts_literal(d, df, "create_time"))
                             & (F.col("create_time") < ts_literal(d + dt.timedelta(days=1), df,
                                                                  "create_time")))
        return df.filter(named)

    regs = window(member).groupBy(day_label("create_time").alias("day")).agg(
        F.count(F.lit(1)).alias("reg_rows"), F.count("id").alias("regs"),
        F.max("id").cast("long").alias("max_member"))
    orders = window(order).groupBy(day_label("create_time").alias("day")).agg(
        F.count(F.lit(1)).alias("order_rows"), F.count("order_id").alias("orders"),
        F.max("order_id").cast("long").alias("max_order"),
        F.sum(F.col("origin_price").cast(MONEY_SUM)).cast(MONEY_SUM).alias("money"))
    return _by_day(regs.unionByName(orders, allowMissingColumns=True))


def _by_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy("day").agg(
        *(F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in _SUMS),
        F.max("max_member").alias("max_member"), F.max("max_order").alias("max_order"),
        F.sum("money").cast(MONEY_SUM).alias("money"))


class GrowthRollup:
    """Closed days in a folder: `close` days, `daily` and `calendar` reports."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def rows(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def mark(self) -> dt.date | None:
        """The last closed day."""
        rows = self.rows()
        last = None if rows is None else rows.agg(F.max("day")).first()[0]
        return None if last is None else dt.date.fromisoformat(last)

    def close(self, member: DataFrame, order: DataFrame, through,
              late: Iterable = ()) -> dt.date:
        """Close all days up to `through` and aggregate the `late` days, closed before, anew."""
        through, mark = as_date(through), self.mark()
        late = sorted({as_date(d) for d in late})
        if mark is not None and any(d > mark for d in late):
            raise ValueError("a late day must be closed already")
        parts = []
        if mark is None or through > mark:
            lower = None if mark is None else mark + dt.timedelta(days=1)
            end = self.spark.createDataFrame([(through.isoformat(),)], "day string")
            parts.append(_by_day(day_rows(member, order, lower, through + dt.timedelta(days=1))
                                 .unionByName(end, allowMissingColumns=True)))
            mark = through
        if late:
            empty = self.spark.createDataFrame([(d.isoformat(),) for d in late], "day string")
            parts.append(_by_day(day_rows(member, order, days=late)
                                 .unionByName(empty, allowMissingColumns=True)))
        if not parts:
            return mark
        new = parts[0]
        for p in parts[1:]:
            new = new.unionByName(p)
        new = written(new.withColumn("month", F.substring("day", 1, 7)), "days")
        old = self.rows()
        if old is not None:
            # As many months as the run touches; their other days stay.
            months = [r.month for r in new.select("month").distinct().collect()]
            kept = old.filter(F.col("month").isin(months)).join(new.select("day"), "day", "left_anti")
            new = new.unionByName(kept.select(new.columns))
        (new.repartition("month").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(self.path))
        return mark

    def _days(self, member: DataFrame, order: DataFrame, upper: dt.date | None) -> DataFrame:
        """A row per day: closed ones from the rollup, open ones from raw rows."""
        closed, mark = self.rows(), self.mark()
        lower = None if mark is None else mark + dt.timedelta(days=1)
        rows = day_rows(member, order, lower, upper)
        if closed is not None:
            if upper is not None:
                closed = closed.filter((F.col("day") < upper.isoformat())
                                       & (F.col("month") <= upper.isoformat()[:7]))
            rows = rows.unionByName(closed.select(rows.columns))
        return rows

    def daily(self, member: DataFrame, order: DataFrame, as_of, days: int = 7,
              until=None) -> DataFrame:
        """As `growth.growth_daily`."""
        lower = (as_date(as_of) - dt.timedelta(days=days)).isoformat()
        rows = self._days(member, order, None if until is None else as_date(until))
        day = F.when(F.col("day") >= lower, F.col("day")).otherwise(PRIOR)
        kept = _by_day(rows.withColumn("day", day)).filter(
            (F.col("day") == PRIOR) | ((F.col("reg_rows") > 0) & (F.col("order_rows") > 0)))
        return (kept.withColumn("gmv", F.coalesce(running("money"), F.lit(0)).cast("double"))
                .filter(F.col("day") != PRIOR)
                .select("day", F.col("regs").alias("regCount"),
                        F.col("max_member").alias("memberCount"),
                        F.col("max_order").alias("orderCount"), "gmv")
                .orderBy("day"))

    def calendar(self, member: DataFrame, order: DataFrame, as_of, days: int = 7) -> DataFrame:
        """As `growth.growth_calendar`."""
        as_of = as_date(as_of)
        first = as_of - dt.timedelta(days=days)
        every = calendar(member, first, as_of - dt.timedelta(days=1))
        rows = self._days(member, order, as_of).unionByName(every, allowMissingColumns=True)
        day = F.when(F.col("day") >= first.isoformat(), F.col("day")).otherwise(PRIOR)
        money = F.coalesce("money", F.lit(0).cast(MONEY_SUM))
        per_day = _by_day(rows.withColumn("day", day)).withColumn("money", money)
        return (per_day.select("day", F.col("regs").alias("regCount"),
                               running("regs").alias("memberCount"),
                               running("orders").alias("orderCount"),
                               running("money").cast("double").alias("gmv"))
                .filter(F.col("day") != PRIOR).orderBy("day"))
