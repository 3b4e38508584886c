"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame over the test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import EXPORT_LINE_SEP
from ..functions import dates as D
from ..operators import (
    funnel,
    growth,
    growth_rollup,
    members,
    reminders,
    segment_index,
    segments,
    tag_state,
    tags,
    words,
)
from ..sources.catalog import CatalogTables, write_tables
from ..sources.shared import shared_folder, written
from ..sources.sinks import write_lines
from ..sources.tables import ShopTables
from ..sources.text import read_lines
from . import params as P

Query = Callable[[SparkSession, str], DataFrame]


def _tag_args(t: ShopTables) -> tuple:
    return (t.member, t.order, t.order_commodity, t.coupon_member, t.coupon, t.delivery,
            t.feedback)


def _user_tags(t: ShopTables) -> DataFrame:
    """The one-row-per-member tag plan; segments are filters over it (a nightly run stores it
    first and reads the stored table, see the tags and segment jobs)."""
    return tags.user_tags(*_tag_args(t))


def _user_tags_incremental(t: ShopTables) -> DataFrame:
    """The tags of a state that took in the shop's rows as an early and a late increment, the
    early one twice (as after a rerun). Members come early, some of them again late."""
    day = F.lit(f"{P.INCREMENT_FROM} 00:00:00")
    coupon_day = F.lit(f"{P.COUPON_INCREMENT_FROM} 00:00:00")

    def half(late: bool) -> tag_state.Increment:
        def pick(df: DataFrame, is_late: Column) -> DataFrame:
            return df.filter(F.coalesce(is_late, F.lit(False)) == late)
        order = pick(t.order, F.col("create_time") >= day)
        return tag_state.Increment(
            member=t.member.filter("id % 5 = 0") if late else t.member, order=order,
            order_commodity=t.order_commodity.join(order.select("order_id"), "order_id", "left_semi"),
            coupon_member=pick(t.coupon_member, F.col("create_time") >= coupon_day),
            delivery=pick(t.delivery, F.col("pick_time") >= day),
            feedback=pick(t.feedback, F.col("id") % 2 == 1))
    state = tag_state.TagState(t.spark, shared_folder(t.spark, "tag-state"), P.STATE_BUCKETS)
    for part, late in (("early", False), ("late", True), ("early", False)):
        state.apply(part, half(late))
    return state.tags(t.coupon)


def _rollup(t: ShopTables) -> growth_rollup.GrowthRollup:
    """A rollup closed in two steps up to some days before the report, one closed day read again."""
    out = growth_rollup.GrowthRollup(t.spark, shared_folder(t.spark, "growth-rollup"))
    out.close(t.member, t.order, P.GROWTH_AS_OF - dt.timedelta(days=30))
    out.close(t.member, t.order, P.GROWTH_AS_OF - dt.timedelta(days=3),
              late=[P.GROWTH_AS_OF - dt.timedelta(days=40)])
    return out


def _catalog(t: ShopTables) -> CatalogTables:
    """Members and orders as tables of a new database, partitioned by month."""
    where = shared_folder(t.spark, "shop-db")
    database = where.rsplit("/", 1)[1].replace("-", "_")
    write_tables(t, database, "month", where, ["t_member", "t_order"])
    return CatalogTables(t.spark, database)


def _growth_catalog(t: ShopTables) -> DataFrame:
    shop = _catalog(t)
    return growth.growth_daily(shop.member, shop.order, P.GROWTH_AS_OF)


def _wow_catalog(t: ShopTables) -> DataFrame:
    return growth.wow_order_compare(_catalog(t).order, P.WOW_ORDER_AS_OF)


def _hot_field_file(t: ShopTables) -> DataFrame:
    """The lines as a text file with CR LF, scanned again."""
    where = shared_folder(t.spark, "lines")
    write_lines(t.lines, where)
    return words.hot_field_counts(read_lines(t.spark, where, line_sep=EXPORT_LINE_SEP))


def _export_file(t: ShopTables) -> DataFrame:
    """The audience export written in its download format and read back."""
    where = shared_folder(t.spark, "export")
    write_lines(segments.segment_export(_user_tags(t), P.SEGMENT_CONDITIONS), where)
    return read_lines(t.spark, where, line_sep=EXPORT_LINE_SEP)


def _segment_page(t: ShopTables) -> DataFrame:
    """One page behind the cursors of the pages before it (each a bounded result)."""
    stored, cursor = written(_user_tags(t), "usertag"), None
    for _ in range(P.PAGE - 1):
        rows = segments.segment_page(stored, P.SEGMENT_CONDITIONS, P.PAGE_SIZE, cursor).collect()
        cursor = segments.Cursor.after(rows) or cursor
    return segments.segment_page(stored, P.SEGMENT_CONDITIONS, P.PAGE_SIZE, cursor)


def _q(fn: Callable[[ShopTables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ShopTables.of(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


QUERIES: dict[str, Query] = {
    # member distribution
    "member_sex": _q(lambda t: members.member_sex(t.member)),
    "member_channel": _q(lambda t: members.member_channel(t.member)),
    "member_mp_sub": _q(lambda t: members.member_mp_sub(t.member)),
    "member_heat": _q(lambda t: members.member_heat(t.member, t.order, t.coupon_member)),
    "member_profile_json": _q(lambda t: members.member_profile_json(t.member, t.order,
                                                                    t.coupon_member)),
    # funnel
    "funnel_counts": _q(lambda t: funnel.funnel_counts(t.order, t.coupon_member)),
    "repeat_buyers": _q(lambda t: funnel.repeat_buyers(t.order)),
    # growth and week over week
    "growth_daily": _q(lambda t: growth.growth_daily(t.member, t.order, P.GROWTH_AS_OF)),
    "growth_calendar": _q(lambda t: growth.growth_calendar(t.member, t.order, P.GROWTH_AS_OF)),
    "growth_daily_rollup": _q(lambda t: _rollup(t).daily(t.member, t.order, P.GROWTH_AS_OF)),
    "growth_calendar_rollup": _q(lambda t: _rollup(t).calendar(t.member, t.order,
                                                               P.GROWTH_AS_OF)),
    "growth_daily_catalog": _q(_growth_catalog),
    "wow_order_catalog": _q(_wow_catalog),
    "wow_reg_daily": _q(lambda t: growth.wow_reg_daily(t.member, P.WOW_REG_AS_OF)),
    "wow_order_daily": _q(lambda t: growth.wow_order_daily(t.order, P.WOW_ORDER_AS_OF)),
    "wow_reg_compare": _q(lambda t: growth.wow_reg_compare(t.member, P.WOW_REG_AS_OF)),
    "wow_order_compare": _q(lambda t: growth.wow_order_compare(t.order, P.WOW_ORDER_AS_OF)),
    # reminders
    "remind_free_daily": _q(lambda t: reminders.remind_free_daily(t.coupon_member,
                                                                  P.REMIND_AS_OF)),
    "remind_coupon_daily": _q(lambda t: reminders.remind_coupon_daily(t.coupon_member,
                                                                      P.REMIND_AS_OF)),
    # hot words
    "hot_field_top10": _q(lambda t: words.hot_field_top(t.lines, 10)),
    "hot_field_rejects": _q(lambda t: words.hot_field_rejects(t.lines)),
    "hot_field_file": _q(_hot_field_file),
    "hot_tokens_top10": _q(lambda t: words.hot_tokens_top(t.documents, 10)),
    # user tags
    "tag_member_base": _q(lambda t: tags.tag_member_base(t.member)),
    "tag_order_behavior": _q(lambda t: tags.tag_order_behavior(t.order, t.order_commodity)),
    "tag_order_behavior_exact": _q(lambda t: tags.tag_order_behavior_exact(t.order,
                                                                           t.order_commodity)),
    "tag_free_coupon": _q(lambda t: tags.tag_free_coupon(t.coupon_member)),
    "tag_coupon_times": _q(lambda t: tags.tag_coupon_times(t.coupon_member)),
    "tag_charge_money": _q(lambda t: tags.tag_charge_money(t.coupon_member, t.coupon)),
    "tag_over_time": _q(lambda t: tags.tag_over_time(t.delivery)),
    "tag_latest_feedback": _q(lambda t: tags.tag_latest_feedback(t.feedback)),
    "user_tags_literal": _q(lambda t: tags.user_tags_literal(*_tag_args(t))),
    "user_tags": _q(_user_tags),
    "user_tags_incremental": _q(_user_tags_incremental),
    # segments
    "segment_select": _q(lambda t: segments.segment_select(_user_tags(t), P.SEGMENT_CONDITIONS)),
    "segment_export": _q(lambda t: segments.segment_export(_user_tags(t), P.SEGMENT_CONDITIONS)),
    "segment_export_file": _q(_export_file),
    "segment_batch": _q(lambda t: segments.segment_batch(_user_tags(t), P.SEGMENT_BATCH)),
    "segment_exclude_only": _q(lambda t: segments.segment_select(_user_tags(t),
                                                                 P.SEGMENT_EXCLUDE_ONLY)),
    "segment_all": _q(lambda t: segments.segment_select(_user_tags(t), [])),
    "segment_from_table": _q(lambda t: segment_index.segment_from_table(
        written(_user_tags(t), "usertag"), t.definitions)),
    "segment_page": _q(_segment_page),
    # date text
    "date_normalize": _q(lambda t: D.date_normalize_report(D.styled_event_dates(t.events))),
    "date_shift": _q(lambda t: D.date_shift_report(D.styled_event_dates(t.events),
                                                   P.DATE_SHIFT)),
    "date_parts": _q(lambda t: D.date_parts_report(D.styled_event_dates(t.events))),
    "date_interval_days": _q(lambda t: D.date_interval_report(D.styled_event_dates(t.events),
                                                              P.DATE_AS_OF)),
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
