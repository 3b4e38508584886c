"""Tags and growth from stored state against the reports over all rows."""

import datetime as dt
import os
import random
import shutil
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from shopgauge.operators import growth, growth_rollup, segments, tag_state, tags
from shopgauge.sources.catalog import CatalogTables, write_tables
from shopgauge.sources.shared import TASK_BYTES, shared_folder, small_tasks

DAY = dt.date(2024, 3, 1)


def shop(spark, seed=2, n=400):
    """Shop rows with nulls, repeated values and a member (3) that holds a third of them."""
    rand = random.Random(seed)

    def member():
        return rand.choice([3, 3, 3, 3, *range(1, 9), None])

    def time(days=40):
        if rand.random() < 0.05:
            return None
        return dt.datetime(2024, 2, 1) + dt.timedelta(days=rand.randrange(days),
                                                      minutes=rand.randrange(1440))

    def money():
        return rand.choice([None, Decimal(rand.randrange(1, 9999)) / 100])
    frames = {
        "member": ([(i, rand.choice(["p%d" % i, "null", None]), rand.choice(["F", "M", None]), i % 3,
                     rand.choice(["null", "o%d" % i]), i, time()) for i in range(1, 11)],
                   "id long, phone string, sex string, member_channel int, mp_open_id string, "
                   "address_default_id long, create_time timestamp_ntz"),
        "order": ([(i if i % 23 else None, member(), rand.randint(1, 3), money(), money(), time())
                   for i in range(n)],
                  "order_id long, member_id long, order_status int, origin_price decimal(18,2), "
                  "pay_price decimal(18,2), create_time timestamp_ntz"),
        "order_commodity": ([(rand.randrange(n + 20), rand.choice([None, *range(6)]))
                             for _ in range(2 * n)], "order_id long, commodity_id long"),
        "coupon": ([(1, None), (2, Decimal(5)), (3, Decimal(7)), (3, Decimal(7))], "id long, coupon_price decimal(18,2)"),
        "coupon_member": ([(member(), rand.choice([1, 2, 3, 4, None]), rand.choice([1, 2, None]),
                            time()) for _ in range(n)],
                          "member_id long, coupon_id long, coupon_channel int, "
                          "create_time timestamp_ntz"),
        "delivery": ([(member(), time(), time()) for _ in range(n)],
                     "member_id long, pick_time timestamp_ntz, arrive_time timestamp_ntz"),
        "feedback": ([(i, member(), rand.randrange(4)) for i in range(n)],
                     "id long, member_id long, feedback_type int"),
    }
    return {k: spark.createDataFrame(r, s).repartition(3) for k, (r, s) in frames.items()}


def increment(f, part=None, parts=3):
    def mine(df, *cols):
        return df if part is None else df.filter(F.pmod(F.xxhash64(*cols), F.lit(parts)) == part)
    order = mine(f["order"], "order_id", "member_id")
    lines = f["order_commodity"]
    if part is not None:
        lines = lines.join(order.select("order_id").distinct(), "order_id", "left_semi")
    return tag_state.Increment(f["member"] if part in (None, 0) else f["member"].filter("id = 2"),
                               order, lines,
                               mine(f["coupon_member"], *f["coupon_member"].columns),
                               mine(f["delivery"], *f["delivery"].columns),
                               mine(f["feedback"], "id"))


def table(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def wide(f):
    return tags.user_tags(*(f[k] for k in ("member", "order", "order_commodity", "coupon_member",
                                           "coupon", "delivery", "feedback")))


def state(spark, buckets=3):
    return tag_state.TagState(spark, shared_folder(spark, "state-test"), buckets)


def test_increments_add_up_to_the_whole(spark):
    f = shop(spark)
    kept = state(spark)
    for part in range(3):
        assert kept.apply(f"2024-03-0{part + 1}", increment(f, part)) > 0
    assert table(kept.tags(f["coupon"])) == table(wide(f))
    before = table(kept.rows())
    assert kept.apply("2024-03-02", increment(f, 1)) == 0 and table(kept.rows()) == before


def test_only_the_partitions_of_new_rows_change(spark):
    f = shop(spark)
    kept = state(spark, 5)
    kept.apply("a", increment(f))
    files = {r.f for r in kept.rows().select(F.input_file_name().alias("f")).distinct().collect()}
    empty = {k: v.limit(0) for k, v in f.items()}
    one = empty | {"feedback": spark.createDataFrame([(10_000, 7, 9)], f["feedback"].schema)}
    assert kept.apply("b", increment(one)) == 1
    now = {r.f for r in kept.rows().select(F.input_file_name().alias("f")).distinct().collect()}
    gone = files - now
    assert gone and all("kind=feedback" in x for x in gone)
    assert len({x.rsplit("/", 1)[0] for x in gone}) == 1
    row = kept.tags(f["coupon"]).filter("memberId = 7").first()
    assert row.feedBack == 9
    assert kept.apply("c", increment(empty)) == 0


def test_a_cut_short_run_goes_on(spark):
    """Some partitions as they were before the run, as if it had ended before it came to them."""
    f = shop(spark)
    kept = state(spark)
    kept.apply("a", increment(f, 0, 2))
    here = kept.path.removeprefix("file:")
    shutil.copytree(here, here + "-before")
    kept.apply("b", increment(f, 1, 2))
    for kind in ("good", "grant", "order"):
        for name in ("bucket=0", "bucket=2"):
            at = f"{here}/kind={kind}/{name}"
            if os.path.exists(at):
                os.rename(at, f"{here}-cut-{kind}-{name}")
                if os.path.exists(old := at.replace(here, here + "-before")):
                    shutil.copytree(old, at)
    assert table(kept.tags(f["coupon"])) != table(wide(f))
    assert kept.apply("b", increment(f, 1, 2)) in range(1, 7)
    assert table(kept.tags(f["coupon"])) == table(wide(f))


def test_a_large_partition_is_merged_and_written_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(tag_state, "PIECE_ROWS", 40)
    monkeypatch.setattr(tag_state, "TASK_ROWS", 20)
    f = shop(spark)
    kept = state(spark, 1)
    sizes = {k: spark.conf.get(k) for k in TASK_BYTES}
    for part in range(2):
        kept.apply(f"{part}", increment(f, part, 2))
    assert {k: spark.conf.get(k) for k in TASK_BYTES} == sizes
    rows = kept.rows()
    assert rows.groupBy(*tag_state.KEYS).count().filter("count > 1").isEmpty()
    files = {r.kind: r["count"] for r in rows.select("kind", F.input_file_name().alias("file"))
             .distinct().groupBy("kind").count().collect()}
    assert files["grant"] > 1 and files["base"] == 1
    assert table(kept.tags(f["coupon"])) == table(wide(f))


def test_jobs_on_state_run_in_small_tasks(spark):
    sizes = {k: spark.conf.get(k) for k in TASK_BYTES}
    with pytest.raises(ZeroDivisionError), small_tasks(spark):
        assert {k: spark.conf.get(k) for k in TASK_BYTES} == {k: str(v) for k, v in TASK_BYTES.items()}
        1 / 0
    assert {k: spark.conf.get(k) for k in TASK_BYTES} == sizes


def test_no_state_and_empty_increments(spark):
    f = {k: v.limit(0) for k, v in shop(spark).items()}
    kept = state(spark)
    with pytest.raises(ValueError):
        kept.tags(f["coupon"])
    assert kept.apply("a", increment(f)) == 0


def rollup(spark):
    return growth_rollup.GrowthRollup(spark, shared_folder(spark, "rollup-test"))


@pytest.mark.parametrize("closed", [[], [20, 9, 0]])
def test_rollup_and_open_days_equal_the_reports(spark, closed):
    f = shop(spark)
    kept = rollup(spark)
    for back in closed:
        kept.close(f["member"], f["order"], DAY - dt.timedelta(days=back))
        assert kept.mark() == DAY - dt.timedelta(days=back)
    args = (f["member"], f["order"], DAY)
    assert table(kept.daily(*args)) == table(growth.growth_daily(*args))
    assert table(kept.daily(*args, until=DAY)) == table(growth.growth_daily(*args, until=DAY))
    assert table(kept.calendar(*args)) == table(growth.growth_calendar(*args))


def test_late_rows_need_their_day_read_again(spark):
    f = shop(spark)
    kept = rollup(spark)
    late = f["order"].filter("date(create_time) = date'2024-02-05'")
    early = f["order"].filter("date(create_time) <> date'2024-02-05' or create_time is null")
    assert late.count()
    kept.close(f["member"], early, DAY - dt.timedelta(days=2))
    args = (f["member"], f["order"], DAY)
    assert table(kept.calendar(*args)) != table(growth.growth_calendar(*args))
    mark = kept.close(*args[:2], DAY - dt.timedelta(days=2), late=[dt.date(2024, 2, 5)])
    assert mark == DAY - dt.timedelta(days=2)
    assert table(kept.calendar(*args)) == table(growth.growth_calendar(*args))
    before = table(kept.rows())
    kept.close(*args[:2], DAY - dt.timedelta(days=2), late=["2024-02-05"])
    assert table(kept.rows()) == before
    with pytest.raises(ValueError):
        kept.close(*args[:2], DAY - dt.timedelta(days=2), late=[DAY])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_raw_rows_of_closed_days_are_not_read(spark):
    f = shop(spark)
    where = shared_folder(spark, "raw")
    for name in ("member", "order"):
        f[name].write.parquet(f"{where}/{name}")
    member, order = (spark.read.parquet(f"{where}/{n}") for n in ("member", "order"))
    kept = rollup(spark)
    kept.close(member, order, DAY - dt.timedelta(days=2))
    text = plan(kept.daily(member, order, DAY))
    assert text.count("GreaterThanOrEqual(create_time,2024-02-29T00:00") >= 2


class Shop:
    def __init__(self, spark, frames):
        self.spark = spark
        self.__dict__.update(frames)


@pytest.mark.parametrize("by", ["dt"])
def test_catalog_tables_are_pruned_and_checked(spark, by):
    f = shop(spark)
    where = shared_folder(spark, "db")
    database = where.rsplit("/", 1)[1].replace("-", "_")
    write_tables(Shop(spark, f), database, by, where)
    write_tables(Shop(spark, f), database, by)  # a rerun replaces the tables
    t = CatalogTables(spark, database)
    args = (t.member, t.order, DAY)
    assert table(growth.growth_daily(*args)) == table(growth.growth_daily(f["member"], f["order"], DAY))
    assert table(growth.growth_calendar(*args)) == table(
        growth.growth_calendar(f["member"], f["order"], DAY))
    compare = growth.wow_order_compare(t.order, DAY)
    assert table(compare) == table(growth.wow_order_compare(f["order"], DAY))
    low = "2024-02-16" if by == "dt" else "2024-02"
    assert f"({by}" in plan(compare).split("PartitionFilters: ")[1].split("]")[0]
    assert low in plan(compare)
    found = tags.user_tags(t.member, t.order, t.order_commodity, t.coupon_member, t.coupon,
                           t.delivery, t.feedback)
    assert table(found) == table(wide(f))
    assert segments.segment_select(found, []).count() == 10
    spark.sql(f"DROP TABLE {database}.t_order")
    f["order"].selectExpr("cast(order_id as string) order_id", "member_id", "create_time",
                          "pay_price", "origin_price").write.saveAsTable(f"{database}.t_order")
    with pytest.raises(ValueError, match="order_id is string, no column order_status"):
        _ = CatalogTables(spark, database).order
    with pytest.raises(ValueError, match="partition by"):
        write_tables(Shop(spark, f), database, "year")
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_a_plain_column_with_a_partition_name_prunes_nothing(spark):
    order = shop(spark)["order"].withColumn("dt", F.lit("1970-01-01"))
    assert table(growth.wow_order_compare(order, DAY)) == table(
        growth.wow_order_compare(shop(spark)["order"], DAY))
