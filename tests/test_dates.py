"""Date text functions: explicit styles, reformatting, every shift unit, parts."""

from shopgauge.functions import dates as D


def row(spark, *cols, txt="2019-11-30 23:59:58"):
    df = spark.createDataFrame([(txt,)], "txt string")
    return df.select(*cols).first()


def test_parse_with_given_style_and_reformat(spark):
    r = row(spark, D.parse_date("txt", "yyyy-MM-dd HH:mm:ss").isNotNull().alias("ok"),
            D.parse_date("txt", "yyyy-MM-dd").isNull().alias("strict"),
            D.reformat("txt", "yyyy年MM月dd日").alias("cn"),
            D.reformat("txt", "MM/dd HH:mm", "yyyy-MM-dd HH:mm:ss").alias("en"))
    assert (r.ok, r.strict, r.cn, r.en) == (True, True, "2019年11月30日", "11/30 23:59")


def test_every_shift_unit(spark):
    ts = D.parse_date("txt")
    r = row(spark, *[D.format_date(fn(ts, 2), D.STAMP).alias(u) for u, fn in D.SHIFTS.items()])
    assert r.asDict() == {"year": "2021-11-30 23:59:58", "month": "2020-01-30 23:59:58",
                          "day": "2019-12-02 23:59:58", "hour": "2019-12-01 01:59:58",
                          "minute": "2019-12-01 00:01:58", "second": "2019-12-01 00:00:00"}


def test_negative_shift_keeps_style(spark):
    df = spark.createDataFrame([("2019年11月",), ("2019/11/30",)], "txt string")
    got = [r.s for r in df.select(D.shift_text("txt", -1, "month").alias("s")).collect()]
    assert got == ["2019年10月", "2019/10/30"]


def test_parts(spark):
    ts = D.parse_date("txt")
    r = row(spark, D.year(ts), D.month(ts), D.day(ts), D.hour(ts), D.minute(ts), D.second(ts),
            D.date_text(ts), D.time_text(ts))
    assert tuple(r) == (2019, 11, 30, 23, 59, 58, "2019-11-30", "23:59:58")


def test_year_less_and_time_only_styles(spark):
    df = spark.createDataFrame([("11-30",), ("10:05:06",), ("02-29",)], "txt string")
    got = [tuple(r) for r in df.select(
        D.detect_style("txt"), D.format_date(D.parse_date("txt"), D.STAMP)).collect()]
    assert got == [("MM-dd", "1970-11-30 00:00:00"), ("HH:mm:ss", "1970-01-01 10:05:06"),
                   (None, None)]


def test_interval_is_symmetric_and_null_safe(spark):
    df = spark.createDataFrame([("2019-03-01", "2019-01-01"), ("bad", "2019-01-01")],
                               "a string, b string")
    got = [r.d for r in df.select(D.interval_days(D.parse_date("a"), D.parse_date("b"))
                                  .alias("d")).collect()]
    assert got == [59, None]


ODD = ["2024-13-01", "2024-02-30", "2024-02-29", "23:59", "24:00", "99:00:00", "١٢-٣٠", "０１-０１", "0000-01",
       "0001-01-01", "12-31 23:59:60", "2024-01-01 ", " 2024-01-01", "2024-1-1", "20240101", "", None,
       "2024年02月29日 01:02:03", "02月30日", "02月28日 1:02", "2024/12/31 23:59:59", "12/31 23:60", "00-00",
       "00:00", "2024-01-01T00:00:00", "2024-01/01", "9999-12-31 23:59:59", "x0-00", "12-31\\n"]


def test_odd_texts_as_each_style_by_itself(spark):
    """The one decoding against a strict parse in every style in turn."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "event_id int, txt string")
    by_style = F.filter(F.array(*[F.struct(F.lit(p).alias("style"), F.try_to_timestamp(
        "txt", F.lit(p)).alias("ts")) for p in D.PATTERNS]), lambda x: x["ts"].isNotNull())
    # Strict parsing takes Unicode digits in no style; a style's text has the style's own length.
    fits = F.filter(by_style, lambda x: F.length(x["style"]) == F.length("txt"))
    want = [(r.s, r.t) for r in df.select(F.get(fits, 0)["style"].alias("s"),
                                          F.get(fits, 0)["ts"].cast("string").alias("t")).collect()]
    got = D.decoded(df).select(D._style_name(F.col("style_number")).alias("s"),
                               F.col("time").cast("string").alias("t"))
    assert [(r.s, r.t) for r in got.collect()] == want
    single = df.select(D.detect_style("txt").alias("s"), D.parse_date("txt").cast("string").alias("t"))
    assert [(r.s, r.t) for r in single.collect()] == want


def test_reports_parse_each_value_once(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "11:12")], "event_id int, txt string").repartition(2)
    for report in (D.date_normalize_report(df), D.date_shift_report(df, 3), D.date_parts_report(df)):
        plan = report._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("gettimestamp(") == 1 and "RLIKE" not in plan
