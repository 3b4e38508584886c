"""Runnable report jobs: each reads the tables of a data folder, computes one family of reports
and writes the results (overwrite, so a rerun replaces its output).

    python -m shopgauge.plans.jobs <job> (--data DIR | --database NAME) --out DIR
        [--as-of YYYY-MM-DD]

Jobs: members, funnel, growth, week, reminders, words, tags, segment.
The segment job reads the tag table written by the tags job (the written table cuts the
lineage: a lost executor recomputes from those files, not from the sources).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ..functions.conditions import parse_request
from ..operators import funnel, growth, members, reminders, segments, tags, words
from ..session import get_session
from ..sources.catalog import CatalogTables
from ..sources.sinks import write_lines, write_tags
from ..sources.tables import ShopTables
from ..sources.text import read_lines
from . import params as P


def _json(df, path: str) -> None:
    df.write.mode("overwrite").json(path)


def members_job(t: ShopTables, out: str, **_) -> None:
    # The profile is already one JSON document: write it as text, not wrapped in a record.
    profile = members.member_profile_json(t.member, t.order, t.coupon_member)
    profile.write.mode("overwrite").text(f"{out}/member_profile")


def funnel_job(t: ShopTables, out: str, **_) -> None:
    _json(funnel.funnel_counts(t.order, t.coupon_member, with_rates=True), f"{out}/funnel")


def growth_job(t: ShopTables, out: str, as_of=None, **_) -> None:
    as_of = as_of or P.GROWTH_AS_OF
    _json(growth.growth_daily(t.member, t.order, as_of), f"{out}/growth_daily")
    _json(growth.growth_calendar(t.member, t.order, as_of), f"{out}/growth_calendar")


def week_job(t: ShopTables, out: str, as_of=None, **_) -> None:
    reg_as_of, order_as_of = as_of or P.WOW_REG_AS_OF, as_of or P.WOW_ORDER_AS_OF
    _json(growth.wow_reg_compare(t.member, reg_as_of), f"{out}/wow_reg")
    _json(growth.wow_order_compare(t.order, order_as_of), f"{out}/wow_order")


def reminders_job(t: ShopTables, out: str, as_of=None, **_) -> None:
    as_of = as_of or P.REMIND_AS_OF
    _json(reminders.remind_free_daily(t.coupon_member, as_of), f"{out}/remind_free")
    _json(reminders.remind_coupon_daily(t.coupon_member, as_of), f"{out}/remind_coupon")


def words_job(t: ShopTables, out: str, lines: str | None = None, **_) -> None:
    source = read_lines(t.spark, lines) if lines else t.lines
    _json(words.hot_field_top(source, 10), f"{out}/hot_field")
    _json(words.hot_field_rejects(source), f"{out}/hot_field_rejects")
    _json(words.hot_tokens_top(t.documents, 10), f"{out}/hot_tokens")


def tags_job(t: ShopTables, out: str, **_) -> None:
    write_tags(tags.user_tags(t.member, t.order, t.order_commodity, t.coupon_member, t.coupon,
                              t.delivery, t.feedback), f"{out}/usertag")


def segment_job(t: ShopTables, out: str, conditions=None, **_) -> None:
    tag_table = t.spark.read.parquet(f"{out}/usertag")
    if conditions is None:
        conditions = P.SEGMENT_CONDITIONS
    write_lines(segments.segment_export(tag_table, conditions), f"{out}/member_export")


JOBS = {"members": members_job, "funnel": funnel_job, "growth": growth_job, "week": week_job,
        "reminders": reminders_job, "words": words_job, "tags": tags_job,
        "segment": segment_job}


def run(spark: SparkSession, job: str, data: str | None, out: str, database: str | None = None,
        **params) -> None:
    """A job over the tables of a data folder, or over those of a catalog database."""
    tables = CatalogTables(spark, database) if database else ShopTables.of(spark, data)
    JOBS[job](tables, out.rstrip("/"), **params)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("job", choices=sorted(JOBS))
    source = ap.add_mutually_exclusive_group(required=True)
    source.add_argument("--data")
    source.add_argument("--database", help="catalog database with t_member, t_order, ...")
    ap.add_argument("--out", required=True)
    ap.add_argument("--as-of", default=None)
    ap.add_argument("--lines", default=None,
                    help="tab-separated text files for the words job (default: the documents)")
    ap.add_argument("--conditions", default=None,
                    help='request body {"selectedTags": [...]} for the segment job')
    args = ap.parse_args(argv)
    params = {}
    if args.as_of:
        params["as_of"] = args.as_of
    if args.lines:
        params["lines"] = args.lines
    if args.conditions:
        params["conditions"] = parse_request(args.conditions)
    run(get_session(), args.job, args.data, args.out, args.database, **params)


if __name__ == "__main__":
    main()
