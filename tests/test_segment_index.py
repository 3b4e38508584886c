"""Segments from a table of definitions, and pages by cursor."""

import datetime as dt
import json
import random

from shopgauge.operators import segment_index, segments

SCHEMA = ("memberId long, phone string, sex string, channel int, orderCount long, "
          "orderMoney double, favGoods array<long>, couponTimes array<string>, active boolean, "
          "born date, rate decimal(10,2), feedBack long")


def members(n=120, seed=1):
    rand = random.Random(seed)

    def some(*values):
        return rand.choice([None, *values])
    rows = [(i if i % 17 else None, f"p{i}", some("F", "M", "null", "x-y"), some(1, 2, 3),
             some(*range(6)), some(0.0, -0.0, 1.5, 20.25, float("nan"), 1e18),
             rand.choice([None, [], [7], [7, 7, 8], [rand.randrange(9), None]]),
             rand.choice([None, [], ["2024-01-0%d" % rand.randint(1, 9)] * rand.randint(1, 3)]),
             some(True, False), some(dt.date(1990, 1, 1), dt.date(2001, 5, 6)),
             some(*[__import__("decimal").Decimal(x) for x in ("1.50", "-2.25", "99.99")]),
             some(1, 2)) for i in range(1, n)]
    return rows


SEGMENTS = {
    "match": [("sex", "F", "match")],
    "number": [("channel", " 2 ", "match"), ("orderCount", "3", "match")],
    "array": [("favGoods", "7", "match")],
    "range": [{"name": "orderCount", "type": "rangeBoth", "lo": "1", "hi": "3"}],
    "half range": [{"name": "orderCount", "type": "rangeBoth", "lo": "4"}],
    "dashed": [("orderCount", "2-4", "rangeBoth")],
    "pair": [{"name": "orderMoney", "type": "rangeBoth", "value": ["0", "20.25"]}],
    "empty range": [("orderCount", "4-2", "rangeBoth")],
    "array range": [{"name": "couponTimes", "type": "rangeBoth", "lo": "2024-01-02", "hi": "2024-01-05"},
                    ("feedBack", None, "exists")],
    "goods range": [("favGoods", "6", "rangeGte"), ("orderMoney", "1", "rangeLte")],
    "exists": [("favGoods", None, "exists"), ("phone", None, "exists"), ("born", None, "exists")],
    "not": [("sex", "F", "notMatch"), ("favGoods", "7", "notMatch")],
    "mixed": [("sex", "M", "match"), ("sex", "F", "match"), ("channel", "1", "notMatch"),
              ("orderCount", "2", "rangeGte"), ("orderCount", "2", "rangeGte")],
    "all": [],
    "bool": [("active", "TRUE", "match")],
    "date": [("born", "1995-01-01", "rangeGte")],
    "decimal": [("rate", "1.5", "match"), ("rate", "-3", "rangeLte")],
    "text range": [("sex", "G", "rangeLte")],
    "zero": [("orderMoney", "0", "match")],
    "nan": [("orderMoney", "1e17", "rangeGte")],
}
FAULTY = {
    "no body": None, "not json": "{x", "no list": "{}", "null list": '{"selectedTags": null}',
    "tag": '{"selectedTags": [{"name": "nope", "type": "exists"}]}',
    "kind": '{"selectedTags": [{"name": "sex", "value": "F", "type": "like"}]}',
    "no value": '{"selectedTags": [{"name": "sex", "type": "match"}]}',
    "unfit": '{"selectedTags": [{"name": "sex", "value": "F", "type": "match"}, '
             '{"name": "orderCount", "value": "many", "type": "match"}]}',
    "bounds": '{"selectedTags": [{"name": "orderCount", "value": "1-2-3", "type": "rangeBoth"}]}',
}


def body(conditions):
    out = []
    for c in conditions:
        if isinstance(c, tuple):
            c = dict(zip(("name", "value", "type"), c))
        out.append(c)
    return json.dumps({"selectedTags": out})


def definitions(spark):
    rows = [(k, body(v)) for k, v in SEGMENTS.items()] + list(FAULTY.items())
    return spark.createDataFrame(rows + rows[:2], "segment_id string, body string").repartition(3)


def rows(df):
    return sorted((r.segment_id, str(r.memberId), r.phone, r.score) for r in df.collect())


def test_same_audiences_as_one_expression_for_each(spark, monkeypatch):
    monkeypatch.setattr(segment_index, "PER_SALT", 5)  # the other tests leave keys unsalted
    monkeypatch.setattr(segment_index, "BUCKETS", 3)
    tags = spark.createDataFrame(members(), SCHEMA).repartition(4)
    got = rows(segment_index.segment_from_table(tags, definitions(spark)))
    want = rows(segments.segment_batch(tags, SEGMENTS))
    assert got == want and {g[0] for g in got} == set(SEGMENTS) - {"empty range"}


def test_faults_are_listed(spark):
    tags = spark.createDataFrame(members(5), SCHEMA)
    found = {r.segment_id: (r.position, r.fault) for r in segment_index.rejected_definitions(
        definitions(spark), tags.schema).collect()}
    assert set(found) == set(FAULTY)
    assert found["unfit"] == (1, "value does not fit the tag")
    assert found["tag"] == (0, "unknown tag") and found["no body"][0] is None


def test_empty_sides_and_extra_columns(spark):
    tags = spark.createDataFrame(members(30), SCHEMA)
    none = spark.createDataFrame([], SCHEMA)
    assert segment_index.segment_from_table(none, definitions(spark)).count() == 0
    assert segment_index.segment_from_table(tags, definitions(spark).limit(0)).count() == 0
    odd = tags.selectExpr("*", "'a' AS key", "1 AS salt", "'x' AS v", "map(1, 2) AS held")
    assert rows(segment_index.segment_from_table(odd, definitions(spark))) == rows(
        segments.segment_batch(tags, SEGMENTS))


def test_the_plan_does_not_grow_with_the_definitions(spark):
    tags = spark.createDataFrame(members(40), SCHEMA)

    def size(n):
        df = spark.createDataFrame([(f"s{i}", body([("favGoods", str(i % 9), "match")]))
                                    for i in range(n)], "segment_id string, body string")
        found = segment_index.segment_from_table(tags, df)
        assert found.select("segment_id").distinct().count() >= min(n, 2)
        return found._jdf.queryExecution().optimizedPlan().toString().count("\n")
    assert size(4) == size(1000)


def test_pairs_of_segment_and_member_are_not_gathered(spark):
    tags = spark.createDataFrame(members(40), SCHEMA)
    found = segment_index.segment_from_table(tags, definitions(spark))
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_many_conditions_and_nodes_of_several_levels(spark, monkeypatch):
    monkeypatch.setattr(segment_index, "BUCKETS", 6)
    monkeypatch.setattr(segment_index, "FAN", 2)
    monkeypatch.setattr(segment_index, "PAIRS", 1000)
    monkeypatch.setattr(segment_index, "BESIDE", 2)
    rand = random.Random(5)
    values = {"favGoods": "012345678", "orderMoney": ["0", "1.5", "20", "nan"],
              "couponTimes": ["2024-01-0%d" % d for d in range(1, 10)]}

    def condition():
        name = rand.choice(sorted(values))
        kind = rand.choice(["match", "notMatch", "rangeBoth", "rangeGte", "rangeLte", "exists"])
        if kind == "rangeBoth":
            lo, hi = (rand.choice(values[name]) for _ in range(2))
            return {"name": name, "type": kind, "lo": lo, "hi": hi}
        return {"name": name, "type": kind, "value": rand.choice(values[name])}
    asked = {f"s{i}": [condition() for _ in range(rand.randint(1, 5))] for i in range(30)}
    tags = spark.createDataFrame(members(60), SCHEMA).repartition(4)
    df = spark.createDataFrame([(k, body(v)) for k, v in asked.items()], "segment_id string, body string")
    got = rows(segment_index.segment_from_table(tags, df))
    assert got == rows(segments.segment_batch(tags, asked)) and len({g[0] for g in got}) > 20


def test_narrow_ranges_meet_few_members(spark, monkeypatch):
    kept = {}

    def keep(df, what, write=segment_index.written):
        kept[what] = write(df, what)
        return kept[what]
    monkeypatch.setattr(segment_index, "written", keep)
    tags = spark.range(4000).selectExpr("id AS memberId", "'p' AS phone", "id * 10D AS orderMoney")
    df = spark.createDataFrame([(f"s{i}", body([{"name": "orderMoney", "type": "rangeBoth",
                                                 "lo": str(i * 100), "hi": str(i * 100 + 15)}]))
                                for i in range(400)] + [("wide", body([("orderMoney", "5", "rangeGte")]))],
                               "segment_id string, body string")
    assert segment_index.segment_from_table(tags, df).count() == 400 * 2 + 3999
    # Two leaves at most for a narrow range; the wide one meets each member once.
    assert kept["key-counts"].selectExpr("sum(pairs)").first()[0] <= 400 * 2 * 2 + 4000


def test_pairs_are_judged_in_generated_code(spark):
    tags = spark.createDataFrame(members(40), SCHEMA)
    asked = {"a": [("sex", "F", "match"), ("channel", "1", "notMatch"), ("favGoods", "6", "rangeGte"),
                   {"name": "couponTimes", "type": "rangeBoth", "lo": "2024-01-02", "hi": "2024-01-05"}]}
    df = spark.createDataFrame([(k, body(v)) for k, v in asked.items()], "segment_id string, body string")
    found = segment_index.segment_from_table(tags, df)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and not any(f"{f}(others" in plan for f in ("exists", "filter"))
    assert rows(found) == rows(segments.segment_batch(tags, asked))


def test_definitions_for_all_members_join_by_a_key(spark, monkeypatch):
    monkeypatch.setattr(segment_index, "LEAST_MEMBERS", 1)
    tags = spark.createDataFrame(members(40), SCHEMA)
    asked = {"all": [], "not": [("sex", "F", "notMatch")], "has": [("born", None, "exists")]}
    df = spark.createDataFrame([(k, body(v)) for k, v in asked.items()], "segment_id string, body string")
    for salted in (100, 5):
        monkeypatch.setattr(segment_index, "PAIRS", salted)
        found = segment_index.segment_from_table(tags, df)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan
        assert rows(found) == rows(segments.segment_batch(tags, asked))


def test_rows_of_one_member_count_together(spark, monkeypatch):
    monkeypatch.setattr(segment_index, "PAIRS", 2)
    tags = spark.createDataFrame(
        [(1, "p", "F", 1, 5), (1, "p", "M", 2, None), (1, "p", "M", 2, None), (1, "q", "M", 1, 2),
         (None, None, "F", None, 1), (None, None, "F", None, 1)],
        "memberId long, phone string, sex string, channel int, orderCount long")
    asked = {"both": [("sex", "F", "match"), ("sex", "M", "match"), ("orderCount", "1", "rangeGte")],
             "not": [("channel", "2", "notMatch")], "out": [("sex", "F", "match"), ("sex", "M", "notMatch")],
             "last": [("orderCount", "9", "rangeGte"), ("orderCount", None, "exists")]}
    df = spark.createDataFrame([(k, body(v)) for k, v in asked.items()], "segment_id string, body string")
    assert sorted(map(tuple, segment_index.segment_from_table(tags, df).selectExpr(
        "segment_id", "string(memberId)", "phone", "score").collect()), key=str) == sorted([
        ("both", "1", "p", 3), ("both", "1", "q", 2), ("both", None, None, 2),
        ("not", "1", "q", 0), ("not", None, None, 0), ("out", None, None, 1),
        ("last", "1", "p", 1), ("last", "1", "q", 1), ("last", None, None, 1)], key=str)


def test_pages_hold_the_audience_once(spark):
    tags = spark.createDataFrame(members(), SCHEMA).repartition(4)
    for name in ("mixed", "empty range"):
        whole = segments.segment_members(tags, SEGMENTS[name]).collect()
        order = sorted(((-r.score, r.memberId is not None, r.memberId or 0, r.phone) for r in whole))
        for size in (9, 1000):
            got = [r for page in segments.pages(tags, SEGMENTS[name], size) for r in page]
            assert [(-r.score, r.memberId is not None, r.memberId or 0, r.phone)
                    for r in got] == order
    cursor = segments.Cursor(2, None, "p1")
    assert segments.Cursor.from_text(cursor.to_text()) == cursor
    assert segments.Cursor.after([]) is None


def test_a_page_is_a_top_k_of_a_filtered_scan(spark):
    tags = spark.createDataFrame(members(), SCHEMA)
    page = segments.segment_page(tags, SEGMENTS["mixed"], 5, segments.Cursor(1, 20, "p20"))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=5" in plan and "Exchange" not in plan
