"""Incremental day-bucketed counts (the reminder and week-over-week reports) with Structured
Streaming: a one-day tumbling event-time window with a watermark, so late rows within the
allowed delay still land in their day and state for closed days is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.reminders import FREE_COUPON_ID, FREE_REMIND_CHANNEL
from ..session import ensure_checkpoint_dir


def daily_counts_stream(events: DataFrame, ts: str, count_col: str, out: str,
                        delay: str = "1 day") -> DataFrame:
    """`day, <out>` per one-day event-time window of a streaming (or batch) frame."""
    t = F.col(ts).cast("timestamp") if events.schema[ts].dataType.typeName() == "timestamp_ntz" \
        else F.col(ts)
    timed = events.withColumn("_event_time", t).withWatermark("_event_time", delay)
    return (timed.groupBy(F.window("_event_time", "1 day"))
            .agg(F.count(count_col).alias(out))
            .select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), out))


def remind_free_stream(coupon_member: DataFrame, delay: str = "1 day") -> DataFrame:
    free = coupon_member.filter((F.col("coupon_id") == FREE_COUPON_ID)
                                & (F.col("coupon_channel") == FREE_REMIND_CHANNEL))
    return daily_counts_stream(free, "create_time", "member_id", "freeCount", delay)


def remind_coupon_stream(coupon_member: DataFrame, delay: str = "1 day") -> DataFrame:
    vouchers = coupon_member.filter(F.col("coupon_id") != FREE_COUPON_ID)
    return daily_counts_stream(vouchers, "create_time", "member_id", "couponCount", delay)


def start(counts: DataFrame, name: str, sink_path: str,
          available_now: bool = True) -> StreamingQuery:
    """Run a daily-count stream into a Parquet folder (append: a day is written once its window
    is closed by the watermark, so a run that ends keeps its newest days for the next one).

    The checkpoint lives under the session's shared checkpoint folder, so a restarted job
    resumes where it stopped.
    """
    base = ensure_checkpoint_dir(counts.sparkSession).rstrip("/")
    writer = (counts.writeStream.queryName(name)
              .option("checkpointLocation", f"{base}/stream-{name}"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.outputMode("append").format("parquet").start(sink_path)
