"""Source tables.

The operators work on the shop schema (members, orders, order lines, coupons, coupon grants,
deliveries, feedback). The test data is a TPC-H-like star schema plus an event table, so each
shop table gets an adapter frame over the raw tables. All adapters are lazy DataFrames: the
optimizer prunes the columns and pushes the filters of the query that uses them into the
Parquet scans.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

MONEY = "decimal(18,2)"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def member_frame(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """t_member: one row per customer; registration time = day of the first order."""
    first = (orders.groupBy("o_custkey")
             .agg(F.min("o_orderdate").alias("first_time")))
    c = customer.alias("c")
    return (c.join(first.alias("f"), F.col("c.c_custkey") == F.col("f.o_custkey"), "left")
            .select(F.col("c.c_custkey").alias("id"),
                    F.when(F.col("c.c_acctbal") < 0, F.lit("null"))
                     .otherwise(F.col("c.c_name")).alias("phone"),
                    F.col("c.c_mktsegment").alias("sex"),
                    F.col("c.c_nationkey").alias("member_channel"),
                    F.when(F.col("c.c_custkey") % 3 == 0, F.lit("null"))
                     .otherwise(F.col("c.c_name")).alias("mp_open_id"),
                    F.col("c.c_nationkey").alias("address_default_id"),
                    F.col("f.first_time").alias("create_time")))


def order_frame(orders: DataFrame) -> DataFrame:
    """t_order: status F -> 2 (placed), O -> 1, anything else -> 3."""
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("member_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit(2))
         .when(F.col("o_orderstatus") == "O", F.lit(1))
         .otherwise(F.lit(3)).alias("order_status"),
        F.col("o_totalprice").cast(MONEY).alias("origin_price"),
        F.col("o_totalprice").cast(MONEY).alias("pay_price"),
        F.col("o_orderdate").alias("create_time"))


def order_commodity_frame(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.col("l_orderkey").alias("order_id"),
                           F.col("l_partkey").alias("commodity_id"))


def coupon_frame(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("id"),
                       F.col("p_retailprice").cast(MONEY).alias("coupon_price"))


def coupon_member_frame(events: DataFrame) -> DataFrame:
    """t_coupon_member: sign-ups are first-order-free coupons (id 1), purchases other coupons."""
    return (events.filter(F.col("event_type").isin("signup", "purchase"))
            .select(F.col("user_id").alias("member_id"),
                    F.when(F.col("event_type") == "signup", F.lit(1).cast("bigint"))
                     .otherwise(F.lit(2) + F.col("event_id") % 100).alias("coupon_id"),
                    (F.lit(1) + F.col("event_id") % 2).alias("coupon_channel"),
                    F.col("ts").alias("create_time")))


def delivery_frame(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """t_delivery: one row per order line; picked on the order day, arrived on the ship day."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    li = lineitem.select("l_orderkey", "l_shipdate")
    return (o.join(li, o.o_orderkey == li.l_orderkey, "inner")
            .select(F.col("o_custkey").alias("member_id"),
                    F.col("o_orderdate").alias("pick_time"),
                    F.col("l_shipdate").alias("arrive_time")))


def feedback_frame(events: DataFrame) -> DataFrame:
    return (events.filter(F.col("event_type").isin("error", "click"))
            .select(F.col("event_id").alias("id"),
                    F.col("user_id").alias("member_id"),
                    (F.col("event_id") % 5).alias("feedback_type")))


def line_frame(documents: DataFrame) -> DataFrame:
    """Tab-separated text lines `doc_id, source, lang` (the hot-word job's input file)."""
    return documents.select(
        F.concat_ws("\t", F.col("doc_id").cast("string"), "source", "lang").alias("line"))


def definition_frame(part: DataFrame) -> DataFrame:
    """Segment definitions, one for each part: segment_id and the request body as JSON text.

    Most ask for the members who bought the part, some for a narrow range of money, a few of each
    thousand for wide audiences, and one of each thousand names a tag that does not exist.
    """
    k = F.col("p_partkey")

    def condition(name: str, kind: str, value=None, lo=None, hi=None) -> Column:
        return F.struct(*(F.lit(v).cast("string").alias(n) for n, v in (
            ("name", name), ("type", kind), ("value", value), ("lo", lo), ("hi", hi))))

    bought = condition("favGoods", "match", k)
    money = (k % 2000) * 1000
    day = F.date_add(F.lit("2024-01-01").cast("date"), (k % 28).cast("int"))
    asked = (F.when(k % 1000 < 400, F.array(bought))
             .when(k % 1000 < 800, F.array(bought, condition("channel", "notMatch", k % 25)))
             .when(k % 1000 < 995, F.array(condition("orderMoney", "rangeBoth", lo=money,
                                                     hi=money + 500)))
             .when(k % 1000 == 995, F.array(
                 condition("couponTimes", "rangeBoth", lo=day, hi=F.date_add(day, 1)),
                 condition("orderCount", "match", k % 30),
                 condition("sex", "notMatch", "BUILDING")))
             .when(k % 1000 == 996, F.array(condition("chargeMoney", "rangeGte", "1000"),
                                            condition("overTime", "rangeLte", "1000000")))
             .when(k % 1000 == 997, F.array(condition("freeCouponTime", "exists"),
                                            condition("sex", "notMatch", "MACHINERY")))
             .when(k % 1000 == 998, F.array(condition("channel", "notMatch", "3"),
                                            condition("sex", "notMatch", "BUILDING")))
             .otherwise(F.array(condition("unheardOf", "match", "1"), bought)))
    return part.select(F.concat(F.lit("part-"), k).alias("segment_id"),
                       F.to_json(F.struct(asked.alias("selectedTags"))).alias("body"))


class ShopTables:
    """Lazy access to the raw tables of one data directory and the shop adapters over them.

    An instance reads each table's file listing and footer once and builds each adapter plan once
    (DataFrames are immutable lazy plans; nothing is cached in memory). Make a new one, as
    `ShopTables.of(spark, dir)` does, to see files that were added since.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "ShopTables":
        return cls(spark, sf_dir)

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = read_table(self.spark, self.sf_dir, name)
        return self._raw[name]

    @cached_property
    def member(self) -> DataFrame:
        return member_frame(self.raw("customer"), self.raw("orders"))

    @cached_property
    def order(self) -> DataFrame:
        return order_frame(self.raw("orders"))

    @cached_property
    def order_commodity(self) -> DataFrame:
        return order_commodity_frame(self.raw("lineitem"))

    @cached_property
    def coupon(self) -> DataFrame:
        return coupon_frame(self.raw("part"))

    @cached_property
    def coupon_member(self) -> DataFrame:
        return coupon_member_frame(self.raw("events"))

    @cached_property
    def delivery(self) -> DataFrame:
        return delivery_frame(self.raw("orders"), self.raw("lineitem"))

    @cached_property
    def feedback(self) -> DataFrame:
        return feedback_frame(self.raw("events"))

    @cached_property
    def lines(self) -> DataFrame:
        return line_frame(self.raw("documents"))

    @cached_property
    def definitions(self) -> DataFrame:
        return definition_frame(self.raw("part"))

    @cached_property
    def documents(self) -> DataFrame:
        return self.raw("documents")

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events")

