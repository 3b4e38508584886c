"""Every planned report stays registered, with oracle SQL, and builds without running."""

import __spark_entry__ as E
from shopgauge import plans

PLANNED = """member_sex member_channel member_mp_sub member_heat member_profile_json funnel_counts
repeat_buyers growth_daily growth_calendar wow_reg_daily wow_order_daily wow_reg_compare
wow_order_compare remind_free_daily remind_coupon_daily hot_field_top10 hot_tokens_top10
tag_member_base tag_order_behavior tag_order_behavior_exact tag_free_coupon tag_coupon_times
tag_charge_money tag_over_time tag_latest_feedback user_tags_literal user_tags segment_select
segment_export segment_batch date_normalize date_shift date_parts date_interval_days
segment_exclude_only segment_all hot_field_rejects segment_from_table segment_page
segment_export_file hot_field_file user_tags_incremental growth_daily_rollup growth_calendar_rollup
growth_daily_catalog wow_order_catalog""".split()


def test_planned_reports_are_registered_with_oracles():
    assert set(PLANNED) <= set(E.queries())
    assert set(plans.queries()) == set(plans.oracle_sql())
    assert set(plans.queries()) <= set(E.queries())


def test_every_query_builds_lazily_with_named_columns(spark):
    # These write tables while they are built; test_oracle runs them.
    writes = ("_rollup", "_catalog", "_incremental", "_file", "segment_from_table", "segment_page")
    for name, fn in plans.queries().items():
        if name.endswith(writes):
            continue
        df = fn(spark, "/root/testdata/sf0.001")
        assert df.columns and all(c and not c.startswith("_") for c in df.columns), name
