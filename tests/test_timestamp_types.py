"""Day reports give the same results on TIMESTAMP (session zone) and TIMESTAMP_NTZ columns."""

from pyspark.sql import functions as F

from shopgauge.operators import growth, reminders, tags, words
from shopgauge.sources.tables import ShopTables

SF = "/root/testdata/sf0.01"


def _ltz(df, *cols):
    return df.select(*[F.col(c).cast("timestamp").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_day_reports_match_on_both_timestamp_types(spark):
    t = ShopTables(spark, SF)
    m_ltz, o_ltz = _ltz(t.member, "create_time"), _ltz(t.order, "create_time")
    cm_ltz = _ltz(t.coupon_member, "create_time")
    assert dict(t.order.dtypes)["create_time"] == "timestamp_ntz"
    assert rows(growth.growth_daily(t.member, t.order, "1995-03-01")) == rows(
        growth.growth_daily(m_ltz, o_ltz, "1995-03-01"))
    assert rows(growth.growth_calendar(t.member, t.order, "1995-03-01")) == rows(
        growth.growth_calendar(m_ltz, o_ltz, "1995-03-01"))
    assert rows(growth.wow_order_compare(t.order, "1998-01-15")) == rows(
        growth.wow_order_compare(o_ltz, "1998-01-15"))
    assert rows(reminders.remind_free_daily(t.coupon_member, "2024-01-30")) == rows(
        reminders.remind_free_daily(cm_ltz, "2024-01-30"))
    assert rows(tags.tag_coupon_times(t.coupon_member)) == rows(tags.tag_coupon_times(cm_ltz))


def test_field_words_with_another_separator(spark):
    lines = spark.createDataFrame([("a|b|x",), ("a|b|x",), ("a|b",), ("a|b|y|z",)], "line string")
    got = [(r.word, r["count"]) for r in words.hot_field_top(lines, 5, sep="|").collect()]
    assert got == [("x", 2), ("y", 1)]
