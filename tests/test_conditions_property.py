"""Property test: compiled conditions agree with a plain-Python evaluation of the same rules."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shopgauge.operators import segments

SCHEMA = "memberId bigint, n bigint, s string, a array<bigint>"

rows_st = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 5)),
              st.one_of(st.none(), st.sampled_from(["x", "y", "z"])),
              st.one_of(st.none(), st.lists(st.integers(0, 5), max_size=3))),
    min_size=1, max_size=12)

cond_st = st.one_of(
    st.tuples(st.just("n"), st.integers(0, 5).map(str), st.sampled_from(
        ["match", "notMatch", "rangeGte", "rangeLte"])),
    st.tuples(st.just("s"), st.sampled_from(["x", "y"]), st.sampled_from(["match", "notMatch"])),
    st.tuples(st.just("a"), st.integers(0, 5).map(str), st.sampled_from(["match", "notMatch"])),
    st.tuples(st.sampled_from(["n", "s", "a"]), st.just(""), st.just("exists")),
    st.tuples(st.just("n"), st.tuples(st.integers(0, 5), st.integers(0, 5)).map(
        lambda p: f"{min(p)}-{max(p)}"), st.just("rangeBoth")),
)


def leaf(row, name, value, kind):
    v = row[name]
    if kind == "exists":
        return v is not None and (not isinstance(v, list) or len(v) > 0)
    if v is None:
        return False
    if name == "a":
        return any(int(value) == x for x in v)
    target = int(value) if name == "n" and kind != "rangeBoth" else value
    if kind in ("match", "notMatch"):
        return v == target
    if kind == "rangeGte":
        return v >= target
    if kind == "rangeLte":
        return v <= target
    lo, hi = (int(x) for x in value.split("-"))
    return lo <= v <= hi


def expected(rows, conds):
    out = []
    for row in rows:
        should = [leaf(row, *c) for c in conds if c[2] != "notMatch"]
        must_not = [leaf(row, *c) for c in conds if c[2] == "notMatch"]
        if (any(should) if should else True) and not any(must_not):
            out.append(row["memberId"])
    return sorted(out)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, conds=st.lists(cond_st, max_size=4))
def test_conditions_match_python(spark, rows, conds):
    data = [(i, n, s, a) for i, (n, s, a) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA)
    dicts = [dict(memberId=i, n=n, s=s, a=a) for i, n, s, a in data]
    got = sorted(r.memberId for r in segments.segment_members(df, conds).collect())
    assert got == expected(dicts, conds)
