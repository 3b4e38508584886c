"""Member distribution counts (pie-chart data): sex, channel, subscription, heat, and the bundle.

Missing phone / missing subscription is the text sentinel 'null' in the member table; a real
SQL NULL falls in neither bucket, exactly as a comparison with the sentinel behaves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import NULL_TEXT


def member_sex(member: DataFrame) -> DataFrame:
    return member.groupBy(F.col("sex").alias("memberSex")).agg(F.count("id").alias("sexCount"))


def member_channel(member: DataFrame) -> DataFrame:
    return (member.groupBy(F.col("member_channel").alias("memberChannel"))
            .agg(F.count("id").alias("channelCount")))


def member_mp_sub(member: DataFrame) -> DataFrame:
    sub = F.col("mp_open_id")
    return member.agg(F.count_if(sub != NULL_TEXT).alias("subCount"),
                      F.count_if(sub == NULL_TEXT).alias("unsubCount"))


def _one_row(parts: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Combine several one-row global aggregates into one row without a join.

    Each part contributes its columns and NULL for the others; a final global aggregate
    (over as many rows as there are parts) picks the single non-NULL value per column.
    """
    names = [c for _, cols in parts for c in cols]
    rows = []
    for df, cols in parts:
        rows.append(df.select(*[F.col(c) if c in cols else F.lit(None).cast("bigint").alias(c)
                                for c in names]))
    unioned = reduce(DataFrame.unionByName, rows)
    return unioned.agg(*[F.max(c).alias(c) for c in names])


def member_heat(member: DataFrame, order: DataFrame, coupon_member: DataFrame,
                order_status: int | None = None) -> DataFrame:
    """coupon / reg / complete / order / orderAgain in one row.

    reg = members without a phone, complete = with one; order = members with exactly one order,
    orderAgain = with two or more (orders of any status unless `order_status` is given).
    """
    coupon = coupon_member.agg(F.count_distinct("member_id").alias("coupon"))
    phone = F.col("phone")
    reg = member.agg(F.count_if(phone == NULL_TEXT).alias("reg"),
                     F.count_if(phone != NULL_TEXT).alias("complete"))
    o = order if order_status is None else order.filter(F.col("order_status") == order_status)
    per_member = o.groupBy("member_id").agg(F.count("order_id").alias("orderCount"))
    again = per_member.agg(F.count_if(F.col("orderCount") == 1).alias("order"),
                           F.count_if(F.col("orderCount") >= 2).alias("orderAgain"))
    return _one_row([(coupon, ["coupon"]), (reg, ["reg", "complete"]),
                     (again, ["order", "orderAgain"])])


def member_profile_json(member: DataFrame, order: DataFrame, coupon_member: DataFrame) -> DataFrame:
    """The four member reports bundled into one JSON document (one row, column `profile`).

    The member table is read once: GROUPING SETS (sex), (channel), () give the per-sex and
    per-channel counts and the table-wide subscription / phone counts from one aggregate. Order
    buckets and coupon holders come from their own aggregates; all parts (a few rows, bounded by
    the number of distinct codes) meet in one global aggregate that builds the document.
    """
    sub, phone = F.col("mp_open_id"), F.col("phone")
    by_code = (member.groupingSets([["sex"], ["member_channel"], []], "sex", "member_channel")
               .agg(F.grouping_id().alias("gid"), F.count("id").alias("n"),
                    F.count_if(sub != NULL_TEXT).alias("subCount"),
                    F.count_if(sub == NULL_TEXT).alias("unsubCount"),
                    F.count_if(phone == NULL_TEXT).alias("reg"),
                    F.count_if(phone != NULL_TEXT).alias("complete")))
    per_member = order.groupBy("member_id").agg(F.count("order_id").alias("c"))
    buckets = per_member.agg(F.count_if(F.col("c") == 1).alias("order"),
                             F.count_if(F.col("c") >= 2).alias("orderAgain"))
    coupon = coupon_member.agg(F.count_distinct("member_id").alias("coupon"))
    parts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                   [by_code, buckets, coupon])
    # grouping_id bits: sex is the high bit, member_channel the low bit (1 = rolled up).
    by_sex, by_channel, overall = F.col("gid") == 1, F.col("gid") == 2, F.col("gid") == 3

    def total(c: str, where=None) -> Column:
        return F.max(F.when(where, F.col(c)) if where is not None else F.col(c))

    bundle = parts.agg(
        F.sort_array(F.collect_list(F.when(by_sex, F.struct(
            F.col("sex").alias("memberSex"), F.col("n").alias("sexCount"))))).alias("memberSexes"),
        F.sort_array(F.collect_list(F.when(by_channel, F.struct(
            F.col("member_channel").alias("memberChannel"), F.col("n").alias("channelCount")))))
        .alias("memberChannels"),
        F.array(F.struct(total("subCount", overall).alias("subCount"),
                         total("unsubCount", overall).alias("unsubCount"))).alias("memberMpSubs"),
        F.struct(total("reg", overall).alias("reg"), total("complete", overall).alias("complete"),
                 total("order").alias("order"), total("orderAgain").alias("orderAgain"),
                 total("coupon").alias("coupon")).alias("memberHeats"))
    return bundle.select(F.to_json(F.struct("memberSexes", "memberChannels", "memberMpSubs",
                                            "memberHeats")).alias("profile"))
