"""The tag table kept up to date by increments.

The state is a table of mergeable figures, one row per (member, kind, item, label): an order row
holds a member's count, money and last time, a good row how often a good was bought, a grant row
how many coupons of an id came on a day, and so on. Two states of different rows merge by one
aggregate over those keys, so a member with a third of all rows stays spread over its keys.

Rows lie in partitions (kind, bucket of the member). An increment, the new rows of a day, touches
the partitions of its own members only: they are read, merged and replaced by a dynamic partition
overwrite. Partitions are merged in pieces of some 200,000 rows by a hash of their keys, as many as
the counted rows ask for, so that a task's memory does not grow with the state. Each partition also
holds a marker per increment that it has taken in. A repeated
increment skips the partitions that hold its marker, so a rerun changes nothing and a run that was
cut short goes on where it stopped.

`tags` gives the same table as `operators.tags.user_tags` over all rows that came in. Prices are
looked up when the tags are read. An order comes with its lines in one increment; a member row
that comes again replaces the earlier one (by the greater increment name).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import CHARGE_CHANNEL, FREE_COUPON_ID
from ..sources.shared import small_tasks, written
from . import tags as T
from .daily import day_label

KEYS = ["kind", "bucket", "member_id", "item", "label", "marker"]
MERGED = {"n": F.sum, "charged": F.sum, "money": F.sum, "first": F.min, "last": F.max,
          "picked": F.max, "base": F.max, "feedback": F.max}
# Rows of a partition that are merged together, and rows of a task on average.
PIECE_ROWS, TASK_ROWS = 200_000, 200_000


@dataclass(frozen=True)
class Increment:
    """New rows of the shop tables."""

    member: DataFrame
    order: DataFrame
    order_commodity: DataFrame
    coupon_member: DataFrame
    delivery: DataFrame
    feedback: DataFrame


def state_rows(new: Increment, part: str) -> DataFrame:
    """The state of some rows by themselves, one row for each of its keys."""
    base = T.tag_member_base(new.member)
    payload = [c for c in T.BASE_COLUMNS if c != "memberId"]
    bases = base.select(F.lit("base").alias("kind"), F.col("memberId").alias("member_id"),
                        F.struct(F.lit(part).alias("part"), *payload).alias("base"))
    bases = bases.groupBy("kind", "member_id").agg(F.max("base").alias("base"))
    orders = (new.order.groupBy("member_id")
              .agg(F.count("order_id").alias("n"), F.max("create_time").alias("last"),
                   F.sum(F.col("pay_price").cast(T.MONEY_SUM)).cast(T.MONEY_SUM).alias("money"))
              .withColumn("kind", F.lit("order")))
    goods = (new.order.select("order_id", "member_id")
             .join(new.order_commodity.filter("commodity_id is not null"), "order_id")
             .groupBy("member_id", F.col("commodity_id").cast("long").alias("item"))
             .agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("good")))
    grants = (new.coupon_member
              .groupBy("member_id", F.col("coupon_id").cast("long").alias("item"),
                       day_label("create_time").alias("label"))
              .agg(F.count(F.lit(1)).alias("n"),
                   F.count_if(F.col("coupon_channel") != CHARGE_CHANNEL).alias("charged"),
                   F.min("create_time").alias("first"))
              .withColumn("kind", F.lit("grant")))
    deliveries = (new.delivery.groupBy("member_id")
                  .agg(F.max("arrive_time").alias("last"), F.max("pick_time").alias("picked"))
                  .withColumn("kind", F.lit("delivery")))
    feedback = (new.feedback.groupBy("member_id")
                .agg(F.max(F.struct("id", "feedback_type")).alias("feedback"))
                .withColumn("kind", F.lit("feedback")))
    out = bases
    for side in (orders, goods, grants, deliveries, feedback):
        for time in ("first", "last", "picked"):
            if time in side.columns:
                side = side.withColumn(time, F.col(time).cast("timestamp"))
        out = out.unionByName(side, allowMissingColumns=True)
    return out.withColumn("marker", F.lit(None).cast("string"))


def merge(states: DataFrame, *within: str) -> DataFrame:
    """Rows of several states as one; `within` names columns that follow from the keys."""
    types = {f.name: f.dataType for f in states.schema.fields}
    return states.groupBy(*KEYS, *within).agg(*(
        f(c).cast(types[c]).alias(c) for c, f in MERGED.items()))


class TagState:
    """A stored state: `apply` increments, read `tags`."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 1024):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def rows(self, schema=None) -> DataFrame | None:
        """The stored rows; None before the first increment."""
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        try:
            return reader.parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _delta(self, new: Increment, part: str) -> DataFrame:
        bucket = F.pmod(F.xxhash64("member_id"), F.lit(self.buckets)).cast("int")
        rows = state_rows(new, part).withColumn("bucket", bucket)
        return written(rows.select(*KEYS, *MERGED), "tag-increment")

    def apply(self, part: str, new: Increment) -> int:
        """Take in an increment; the number of partitions (kind, bucket) that changed."""
        with small_tasks(self.spark):
            return self._apply(part, new)

    def _apply(self, part: str, new: Increment) -> int:
        delta = self._delta(new, part)
        # One row for each kind and bucket at most.
        sizes = self._sizes(delta)
        todo = set(sizes)
        stored = self.rows(delta.schema)
        if stored is not None and todo:
            mine = stored.filter(self._in(todo) & (F.col("marker") == part))
            todo -= {(r.kind, r.bucket) for r in mine.select("kind", "bucket").distinct().collect()}
        if not todo:
            return 0
        here = self._in(todo)
        marks = self.spark.createDataFrame(sorted(todo), "kind string, bucket int").withColumn(
            "marker", F.lit(part))
        rows = delta.filter(here).unionByName(marks, allowMissingColumns=True)
        if stored is not None:
            rows = rows.unionByName(stored.filter(here))
            for at, n in self._sizes(stored.filter(here)).items():
                sizes[at] += n
        # One shuffle to the partitions that are written; a large one takes a file for each piece.
        sizes = {at: sizes[at] for at in todo}
        pieces = self.spark.createDataFrame(
            [(*at, -(-n // PIECE_ROWS)) for at, n in sorted(sizes.items())],
            "kind string, bucket int, pieces long")
        rows = (rows.join(F.broadcast(pieces), ["kind", "bucket"])
                .withColumn("piece", F.pmod(F.xxhash64("member_id", "item", "label"), "pieces"))
                .repartition(-(-sum(sizes.values()) // TASK_ROWS), "kind", "bucket", "piece"))
        (merge(rows, "piece").drop("piece").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("kind", "bucket")
         .parquet(self.path))
        return len(todo)

    @staticmethod
    def _sizes(rows: DataFrame) -> dict[tuple[str, int], int]:
        """Rows of every kind and bucket (one entry for each at most)."""
        return {(r.kind, r.bucket): r["count"]
                for r in rows.groupBy("kind", "bucket").count().collect()}

    def _in(self, pairs: set[tuple[str, int]]):
        """Rows of some partitions, as a filter on the partition columns."""
        kinds: dict[str, list[int]] = {}
        for kind, bucket in sorted(pairs):
            kinds.setdefault(kind, []).append(bucket)
        out = F.lit(False)
        for kind, buckets in kinds.items():
            out = out | ((F.col("kind") == kind) & F.col("bucket").isin(buckets))
        return out

    def tags(self, coupon: DataFrame) -> DataFrame:
        """The wide tag table, one row per member."""
        rows = self.rows()
        if rows is None:
            raise ValueError(f"no increment has come to {self.path}")
        rows = rows.filter("marker is null")

        def kind(name: str) -> DataFrame:
            return rows.filter(F.col("kind") == name)
        base = kind("base").select(F.col("member_id").alias("memberId"),
                                   *(F.col(f"base.{c}").alias(c) for c in T.BASE_COLUMNS
                                     if c != "memberId"))
        orders = kind("order").select(
            "member_id", F.lit(1).alias("order_id"), F.col("n").alias("w"), "money",
            F.col("last").alias("create_time"))
        goods = kind("good").select("member_id", F.col("item").alias("commodity_id"))
        free = F.col("item") == FREE_COUPON_ID
        grants = kind("grant").select(
            "member_id", F.col("label").alias("day"), F.col("item").alias("coupon_id"),
            F.when(free, F.col("n")).otherwise(0).alias("n_free"),
            F.when(F.col("item") != FREE_COUPON_ID, F.col("n")).otherwise(0).alias("n_voucher"),
            F.col("charged").alias("n_charged"), F.when(free, F.col("first")).alias("first_free"))
        over = kind("delivery").select(
            F.col("member_id").alias("memberId"),
            (F.unix_timestamp("last") - F.unix_timestamp("picked")).alias("overTime"))
        feedback = kind("feedback").select(F.col("member_id").alias("memberId"),
                                           F.col("feedback.feedback_type").alias("feedBack"))
        return T.wide(base, T.order_tags(orders, goods), T.coupon_tags(grants, coupon), over,
                      feedback)
