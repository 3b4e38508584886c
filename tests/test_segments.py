"""Audience conditions (E16-E20) and the segment operators."""

import pytest

from shopgauge.functions.conditions import Condition, parse_request
from shopgauge.operators import segments

TAGS = ("memberId bigint, phone string, sex string, channel int, orderCount bigint, "
        "orderTime string, favGoods array<bigint>, chargeMoney double")


def _tags(spark, n=5):
    rows = [(i, f"p{i}", "M" if i % 2 else "F", i % 3, i, f"2019-11-{10 + i:02d}",
             [i, 100 + i] if i % 2 else [], float(i * 10) if i != 3 else None)
            for i in range(1, n + 1)]
    return spark.createDataFrame(rows, TAGS)


def ids(df):
    return sorted(r.memberId for r in df.collect())


def test_e16_only_not_match_keeps_all_others(spark):
    got = segments.segment_select(_tags(spark), [{"name": "sex", "value": "M",
                                                  "type": "notMatch"}])
    assert ids(got) == [2, 4]


def test_not_match_keeps_missing_tag(spark):
    got = segments.segment_select(_tags(spark), [("chargeMoney", "20", "notMatch")])
    assert ids(got) == [1, 3, 4, 5]


def test_e17_no_condition_selects_all(spark):
    assert ids(segments.segment_select(_tags(spark), [])) == [1, 2, 3, 4, 5]


def test_should_is_or_and_must_not_subtracts(spark):
    conds = [{"name": "orderCount", "lo": "1", "hi": "2", "type": "rangeBoth"},
             {"name": "chargeMoney", "value": "50", "type": "rangeGte"},
             {"name": "channel", "value": "2", "type": "notMatch"}]
    assert ids(segments.segment_select(_tags(spark), conds)) == [1]


def test_e19_match_on_array(spark):
    got = segments.segment_select(_tags(spark), [("favGoods", "103", "match")])
    assert ids(got) == [3]


def test_exists_on_empty_array_is_false(spark):
    got = segments.segment_select(_tags(spark), [{"name": "favGoods", "type": "exists"}])
    assert ids(got) == [1, 3, 5]


def test_range_lte_and_string_range(spark):
    conds = [{"name": "orderTime", "value": "2019-11-12", "type": "rangeLte"}]
    assert ids(segments.segment_select(_tags(spark), conds)) == [1, 2]


def test_e18_range_both_text_is_checked(spark):
    with pytest.raises(ValueError):
        segments.segment_select(_tags(spark), [("orderTime", "2019-11-01-2019-11-30",
                                                "rangeBoth")])
    got = segments.segment_select(_tags(spark), [("orderCount", "2-3", "rangeBoth")])
    assert ids(got) == [2, 3]


def test_bad_value_and_unknown_type_raise(spark):
    with pytest.raises(ValueError):
        segments.segment_select(_tags(spark), [("orderCount", "abc", "match")])
    with pytest.raises(ValueError):
        Condition.of({"name": "sex", "value": "M", "type": "fuzzy"})


def test_e20_a_page_is_best_score_first_and_only_on_request(spark):
    rows = [(i, f"p{i}", "M" if i % 3 == 0 else "F", 0, i, "2019-11-01", [], None)
            for i in range(1, 1201)]
    df = spark.createDataFrame(rows, TAGS)
    conds = [("sex", "M", "match"), ("sex", "F", "match"), ("orderCount", "1100", "rangeGte")]
    got = [r.memberId for r in segments.segment_select(df, conds, size=1000).collect()]
    # All 1200 match; the 101 members meeting two conditions come first, then by memberId.
    assert got == list(range(1100, 1201)) + list(range(1, 900))
    later = segments.segment_select(df, conds, size=1000, offset=1000).collect()
    assert [r.memberId for r in later] == list(range(900, 1100))
    # Without a page the audience is whole and unsorted.
    whole = segments.segment_select(df, conds)
    assert whole.count() == segments.segment_members(df, conds).count() == 1200
    assert segments.segment_export(df, conds).count() == 1200
    assert "Sort" not in whole._jdf.queryExecution().executedPlan().toString()


def test_conditions_are_checked_and_one_sided_ranges_work(spark):
    df = _tags(spark)
    with pytest.raises(ValueError):
        Condition(name="sex", type="fuzzy", value="M")
    for kind in ("match", "notMatch", "rangeGte", "rangeLte"):
        with pytest.raises(ValueError):
            Condition.of({"name": "sex", "type": kind})
    with pytest.raises(ValueError):
        parse_request("{}")
    assert parse_request('{"selectedTags": []}') == []
    for bound, kind in (("hi", "rangeLte"), ("lo", "rangeGte")):
        for name, value in (("sex", "F"), ("orderCount", "2")):
            one = segments.segment_select(df, [{"name": name, "type": "rangeBoth", bound: value}])
            other = segments.segment_select(df, [(name, value, kind)])
            assert sorted(one.collect()) == sorted(other.collect()) != []


def test_export_lines_and_batch(spark):
    df = _tags(spark)
    lines = [r.line for r in segments.segment_export(df, [("sex", "F", "match")]).collect()]
    assert sorted(lines) == ["[2,p2]", "[4,p4]"]
    batch = segments.segment_batch(df, {"f": [("sex", "F", "match")], "all": []})
    got = sorted((r.segment_id, r.memberId) for r in batch.collect())
    assert got == sorted([("f", 2), ("f", 4)] + [("all", i) for i in range(1, 6)])


def test_batch_equals_select_without_limit(spark):
    df = _tags(spark)
    conds = [("channel", "1", "match"), ("chargeMoney", "40", "rangeGte"),
             ("sex", "F", "notMatch")]
    one = ids(segments.segment_members(df, conds))
    batch = segments.segment_batch(df, {"s": conds}).collect()
    assert sorted(r.memberId for r in batch) == one


def test_request_body(spark):
    conds = parse_request('{"selectedTags": [{"name": "sex", "value": "M", "type": "match"}]}')
    assert ids(segments.segment_select(_tags(spark), conds)) == [1, 3, 5]


def test_batch_in_several_passes_equals_one_pass(spark):
    df = _tags(spark)
    segs = {f"s{k}": [("orderCount", str(k % 5), "rangeGte"), ("sex", "F", "notMatch")]
            for k in range(7)}
    one = sorted(tuple(r) for r in segments.segment_batch(df, segs).collect())
    many = sorted(tuple(r) for r in segments.segment_batch(df, segs, per_pass=3).collect())
    assert one == many and len(one) > 0
