"""Day-bucketed counts and calendars shared by the growth, week-over-week and reminder reports.

Time filters compare the raw timestamp column with a typed literal, so they reach the Parquet
scan as pushed filters; the day label is formatted only after filtering.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import DAY_FORMAT

DAY_FMT = DAY_FORMAT


def as_date(value: str | dt.date | dt.datetime) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def ts_literal(day: dt.date, like: DataFrame | None = None, column: str | None = None) -> Column:
    """Midnight of `day` as a literal of the column's own timestamp type (NTZ or LTZ).

    Built from ISO text, so the bound does not depend on the Python process's local zone (an
    LTZ bound is read in the session zone, as the column's values are).
    """
    text = f"{day.isoformat()} 00:00:00"
    kind = "timestamp"
    if like is not None and column is not None:
        if like.schema[column].dataType.typeName() == "timestamp_ntz":
            kind = "timestamp_ntz"
    return F.lit(text).cast(kind)


def day_label(ts: str | Column) -> Column:
    return F.date_format(ts, DAY_FMT)


# Key of a column's metadata that names the time column whose day or month it holds, and how the
# partition values are written.
PARTITION_OF, PARTITION_FORMAT = "partition_of", "partition_format"


def time_window(df: DataFrame, ts: str, lower: dt.date | None, upper: dt.date | None) -> DataFrame:
    """Rows with lower <= ts < upper (either bound optional).

    If a column is marked as the partition column of `ts`, the same bounds prune the partitions.
    """
    for field in df.schema.fields:
        if field.metadata.get(PARTITION_OF) == ts:
            fmt = field.metadata[PARTITION_FORMAT]
            if lower is not None:
                df = df.filter(F.col(field.name) >= lower.strftime(fmt))
            if upper is not None:
                df = df.filter(F.col(field.name) <= (upper - dt.timedelta(days=1)).strftime(fmt))
    cond = None
    if lower is not None:
        cond = F.col(ts) >= ts_literal(lower, df, ts)
    if upper is not None:
        u = F.col(ts) < ts_literal(upper, df, ts)
        cond = u if cond is None else cond & u
    return df if cond is None else df.filter(cond)


def daily_counts(df: DataFrame, ts: str, count_col: str, out: str,
                 lower: dt.date | None = None, upper: dt.date | None = None) -> DataFrame:
    """`day, <out>` = count(count_col) per formatted day of `ts` within [lower, upper)."""
    return (time_window(df, ts, lower, upper)
            .groupBy(day_label(ts).alias("day"))
            .agg(F.count(count_col).alias(out)))


def calendar(spark_df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day label from `first` to `last` inclusive (a handful of rows)."""
    return (spark_df.sparkSession.range(1)
            .select(F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day")))
                    .alias("d"))
            .select(F.date_format("d", DAY_FMT).alias("day")))
