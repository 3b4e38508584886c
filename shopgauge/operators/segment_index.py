"""Segments from a table of definitions: one join of members and conditions, whatever their number.

A definition row is (segment_id, body), the body a request `{"selectedTags": [{name, value, type},
...]}` as in `functions.conditions`, parsed by Spark. Instead of an expression per segment (see
`segments.segment_batch`), conditions and members meet by key:

* a should condition becomes one row per key it asks for: its value for match, one key for exists,
  the nodes that make up a range, and one key that all members hold for definitions without a
  should condition; the definition's other conditions travel in the row;
* a member becomes one row per key it holds, for the tags and kinds that any should condition asks
  for, with the values of those tags that some definition combines with this one;
* equal keys meet in an equi-join, one for each tag and kind, and the joined row decides: the range
  exactly, the other conditions on the values beside it. The first should condition that a member
  meets gives the pair (segment, member), so pairs are neither gathered nor shuffled, however many
  there are. A pair is judged in generated code, without a lambda.

The plan does not grow with the number of definitions: expressions are per tag column. Keys that
very many members hold (a third of them may share a value), or that give very many pairs, are
counted first; members of such a key are dealt over salts and its conditions repeated once per
salt, and a join of very many pairs gets tasks by its pairs, not by its bytes. The leaves of a tag's
values come from the quantiles of a bounded sample of members; FAN leaves make a node, FAN nodes the
next. They steer the cost only, never the result.

A definition with a fault (a body that does not parse, an unknown tag or kind, a value that does
not fit the tag's type) is left out as a whole and listed by `rejected_definitions`.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conditions import KINDS, MUST_NOT_KINDS
from ..sources.shared import shared_folder, written

BODY = ("selectedTags array<struct<name: string, value: string, type: string, lo: string, "
        "hi: string>>")
RANGES = ("rangeBoth", "rangeGte", "rangeLte")
# Leaves of a tag's values and how many of them (or of its nodes) make a node; members sampled for
# the bounds, values taken of a sampled array.
BUCKETS, FAN, SAMPLED, SAMPLED_VALUES = 4096, 16, 16_384, 16
# Member rows and pairs of one key that a task may take, members a salt holds at least, and keys
# that are salted at most (each key beyond them gives less than 1/SALTED of all pairs).
PER_SALT, PAIRS, LEAST_MEMBERS, SALTED = 100_000, 5_000_000, 16, 4096
# Other conditions of a definition that are judged in generated code (with more, by a lambda), and
# how many tests (conditions times the tags and shapes they may have) that code may hold.
BESIDE, TESTS = 4, 24
# A member's value is a whole number, a double or a text; the other two are NULL.
_SPACES = ("n", "d", "t")


def _element(dtype: T.DataType) -> T.DataType:
    return dtype.elementType if isinstance(dtype, T.ArrayType) else dtype


def _space(dtype: T.DataType, name: str) -> str:
    """Which of the three comparable forms a tag's values have."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "d"
    if isinstance(dtype, T.StringType):
        return "t"
    if isinstance(dtype, T.DecimalType) and dtype.precision > 18 or isinstance(
            dtype, (T.MapType, T.StructType, T.ArrayType, T.BinaryType)):
        raise ValueError(f"tag {name!r} of type {dtype.simpleString()} takes no conditions")
    return "n"


def _whole(value: Column, dtype: T.DataType) -> Column:
    """A value of an integral, decimal, boolean, date or timestamp type as a whole number."""
    if isinstance(dtype, T.DecimalType):
        return (value * F.lit(10 ** dtype.scale).cast("decimal(19,0)")).cast("bigint")
    if isinstance(dtype, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp"))
    return value.cast("bigint")


def _held(value: Column, dtype: T.DataType, name: str) -> dict[str, Column]:
    """A member's value in its form."""
    space = _space(dtype, name)
    out = {s: F.lit(None).cast(k) for s, k in zip(_SPACES, ("bigint", "double", "string"))}
    # Adding zero turns -0.0 into 0.0.
    out[space] = {"d": lambda: value.cast("double") + F.lit(0.0), "t": lambda: value.cast("string"),
                  "n": lambda: _whole(value, dtype)}[space]()
    return out


def _asked(text: Column, schema: T.StructType, name: Column) -> Column:
    """A condition's text as (n, d, t) in the form of the tag it names; all NULL if it does not
    fit the tag's type."""
    nothing = F.struct(*(v.alias(s) for s, v in _held(F.lit(None), T.StringType(), "").items()))
    out = F.lit(None).cast("struct<n: bigint, d: double, t: string>")
    for field in schema.fields:
        dtype = _element(field.dataType)
        try:
            space = _space(dtype, field.name)
        except ValueError:
            continue
        if space == "t":
            typed = text
        elif isinstance(dtype, T.BooleanType):
            typed = F.when(F.lower(F.trim(text)).isin("true", "false"),
                           F.lower(F.trim(text)) == "true")
        else:
            wide = dtype if not isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)) \
                else T.LongType()
            typed = F.trim(text).try_cast(wide)
        value = F.struct(*(v.alias(s) for s, v in _held(typed, dtype, field.name).items()))
        out = F.when(name == field.name, F.when(typed.isNull(), nothing).otherwise(value)
                     ).otherwise(out)
    return out


def _given(v: Column) -> Column:
    return F.coalesce(v["n"].isNotNull() | v["d"].isNotNull() | v["t"].isNotNull(), F.lit(False))


def _conditions(definitions: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per condition: segment_id, body, position, name, kind, value, lo, hi (typed), fault.
    An empty list gives one row without a position, a body without a list one with a fault."""
    tags = F.from_json("body", BODY)["selectedTags"]
    listed = definitions.select("segment_id", "body", tags.alias("tags"))
    c, kind, text = F.col("c"), F.col("kind"), F.col("text")
    rows = listed.select("segment_id", "body", F.col("tags").isNull().alias("unread"),
                         F.posexplode_outer("tags").alias("position", "c"))
    rows = rows.select("segment_id", "body", "unread", "position", c["name"].alias("name"),
                       c["type"].alias("kind"), c["value"].alias("text"), c["lo"].alias("low"),
                       c["hi"].alias("high"),
                       F.when(c["type"] == "rangeBoth", F.from_json(c["value"], "array<string>"))
                       .alias("pair"),
                       F.when(c["type"] == "rangeBoth", F.split(c["value"], "-")).alias("dash"))
    apart = F.col("low").isNotNull() | F.col("high").isNotNull()
    pair, dash = F.col("pair"), F.col("dash")
    paired = (F.size(pair) == 2) & (F.get(pair, 0).isNotNull() | F.get(pair, 1).isNotNull())
    dashed = (F.size(dash) == 2) & (F.get(dash, 0) != "") & (F.get(dash, 1) != "")

    def end(own: str, column: str, at: int) -> Column:
        return (F.when(kind == own, text).when(kind != "rangeBoth", F.lit(None))
                .when(apart, F.col(column)).when(paired, F.get(pair, at))
                .when(dashed, F.get(dash, at)).alias(column))
    rows = rows.select("segment_id", "body", "unread", "position", "name", "kind",
                       F.when(kind.isin("match", "notMatch"), text).alias("key"),
                       end("rangeGte", "low", 0), end("rangeLte", "high", 1))
    name = F.col("name")
    rows = rows.select("*", *(_asked(F.col(x), schema, name).alias(y) for x, y in (
        ("key", "value"), ("low", "lo"), ("high", "hi"))))
    unfit = F.lit(False)
    for given, typed in (("key", "value"), ("low", "lo"), ("high", "hi")):
        unfit = unfit | (F.col(given).isNotNull() & ~_given(F.col(typed)))
    fault = (F.when(F.col("unread"), "no list of conditions")
             .when(F.col("position").isNull(), F.lit(None))
             .when(kind.isNull() | ~kind.isin(*KINDS), "unknown condition type")
             .when(name.isNull() | ~name.isin(*[f.name for f in schema.fields]), "unknown tag")
             .when(kind.isin("match", "notMatch") & F.col("key").isNull(), "no value")
             .when(kind.isin(*RANGES) & F.col("low").isNull() & F.col("high").isNull(), "no bounds")
             .when(unfit, "value does not fit the tag"))
    return rows.select("segment_id", "body", "position", "name", "kind", "value", "lo", "hi",
                       fault.alias("fault"))


def rejected_definitions(definitions: DataFrame, schema: T.StructType) -> DataFrame:
    """segment_id, position, fault of every condition that cannot be used, and one row with no
    position for a body without a list of conditions."""
    return (_conditions(definitions, schema).filter("fault is not null")
            .select("segment_id", "position", "fault"))


def _bucket(v: Column, bounds: list, kind: str) -> Column:
    """How many of the sorted bounds are at or below a value, by halving."""
    if not bounds:
        return F.lit(0)
    listed = F.from_json(F.lit(json.dumps(bounds)), f"array<{kind}>")
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))))
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(
        F.coalesce(F.get(listed, at + step - 1) <= v, F.lit(False)), step).otherwise(0))


def _levels(bounds: list) -> range:
    """Levels of nodes over the leaves (0), the last of at most FAN nodes."""
    n = 1
    while FAN ** n < len(bounds) + 1:
        n += 1
    return range(n)


def _node(leaf: Column, level: int) -> Column:
    """The key of the node of a level that a leaf lies in."""
    return F.concat(F.lit(f"{level}:"), F.floor(leaf / FAN ** level).cast("string"))


def _nodes(first: Column, last: Column, levels: range) -> Column:
    """The fewest nodes that hold the leaves first..last and no other, as (level, key)."""
    def up(x: Column, level: int) -> Column:
        return F.ceil(x / FAN ** level).cast("int")

    def down(x: Column, level: int) -> Column:
        return F.floor(x / FAN ** level).cast("int")

    def run(start: Column, end: Column, level: int) -> Column:
        found = F.when(start < end, F.sequence(start, end - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(found, lambda k: F.struct(F.lit(level).alias("level"), F.concat(
            F.lit(f"{level}:"), k.cast("string")).alias("key")))

    out, end = [], last + 1
    for level in levels:
        at, to = up(first, level), down(end, level)
        if level == levels[-1]:
            out.append(run(at, to, level))
            continue
        # What a node above holds whole is left to it.
        above, beyond = up(first, level + 1), down(end, level + 1)
        held = above < beyond
        out.append(run(at, F.when(held, above * FAN).otherwise(to), level))
        out.append(run(F.when(held, beyond * FAN).otherwise(to), to, level))
    return F.concat(*out)


def _values(tags: DataFrame, name: str) -> Column:
    """A row's values of one tag in its form, as an array without NULLs."""
    dtype = tags.schema[name].dataType
    col, elem = F.col(f"`{name}`"), _element(dtype)
    found = F.filter(col if isinstance(dtype, T.ArrayType) else F.array(col),
                     lambda x: x.isNotNull())
    typed = F.transform(found, lambda x: _held(x, elem, name)[_space(elem, name)])
    return F.coalesce(typed, F.array().cast(typed_array(tags, name)))


def typed_array(tags: DataFrame, name: str) -> str:
    space = _space(_element(tags.schema[name].dataType), name)
    return f"array<{dict(zip(_SPACES, ('bigint', 'double', 'string')))[space]}>"


def _there(tags: DataFrame, name: str) -> Column:
    col = F.col(f"`{name}`")
    return F.coalesce(F.size(col) > 0, F.lit(False)) \
        if isinstance(tags.schema[name].dataType, T.ArrayType) else col.isNotNull()


def _people(tags: DataFrame, names: list[str]) -> DataFrame:
    """memberId, phone and for each tag i its sorted distinct values v<i> and presence h<i>: one row
    for each (memberId, phone), which holds what any of its rows holds."""
    person = ["memberId", "phone"]
    rows = tags.select(*person, *(c for i, n in enumerate(names) for c in (
        F.array_sort(F.array_distinct(_values(tags, n))).alias(f"v{i}"),
        _there(tags, n).alias(f"h{i}"))))
    if not names:
        return rows.distinct()
    # Rows are gathered only if any come more than once.
    if not tags.groupBy(*person).count().filter("count > 1").head(1):
        return rows
    return rows.groupBy(*person).agg(*(c for i in range(len(names)) for c in (
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(f"v{i}")))).alias(f"v{i}"),
        F.max(f"h{i}").alias(f"h{i}"))))


def _bounds(people: DataFrame, at: dict[str, int]) -> dict[str, list]:
    """Sorted bucket bounds of tags (name -> i) from the members with the lowest hashes (a top-k, so
    at most SAMPLED rows reach the driver)."""
    if not at:
        return {}
    rows = (people.select(F.xxhash64("memberId").alias("h"),
                          *(F.slice(f"v{i}", 1, SAMPLED_VALUES).alias(f"v{i}")
                            for i in at.values()))
            .orderBy("h").limit(SAMPLED).collect())
    out = {}
    for n, i in at.items():
        # NaN has no place among bounds.
        seen = sorted({v for r in rows for v in r[f"v{i}"] if v == v})
        step = max(1, len(seen) // BUCKETS)
        out[n] = seen[step::step][:BUCKETS - 1]
    return out


@dataclass(frozen=True)
class _Plan:
    """What the definitions ask of the tags: `at` numbers the tags, `spaces` has their forms,
    `bounds` those of their leaves. A side is the tag and shape of a should condition, ("", "")
    that of definitions without one; its `others` are the tags and shapes that some definition
    combines with it, `most` the most of them in one definition."""

    at: dict[str, int]
    spaces: dict[str, str]
    bounds: dict[str, list]
    others: dict[tuple[str, str], list[tuple[str, str]]]
    most: dict[tuple[str, str], int]

    @property
    def sides(self) -> list[tuple[str, str]]:
        return sorted(self.others)

    def unrolled(self, side: tuple[str, str]) -> int:
        """How many other conditions of a definition are judged in generated code."""
        return min(self.most[side], BESIDE, TESTS // max(1, len(self.others[side])))

    @property
    def kinds(self) -> list[tuple[str, str]]:
        return sorted({o for found in self.others.values() for o in found})


def _rules(definitions: DataFrame, schema: T.StructType) -> DataFrame:
    """segment_id and `all` conditions of each definition without a fault, equal rows once."""
    parsed = _conditions(definitions.select("segment_id", "body").distinct(), schema)
    kind = F.col("kind")
    shape = (F.when(kind.isin("match", "notMatch"), "match").when(kind == "exists", "exists")
             .otherwise("range"))
    return (parsed.groupBy("segment_id", "body").agg(
        F.max(F.col("fault").isNotNull()).alias("faulty"),
        F.collect_list(F.when(F.col("position").isNotNull(), F.struct(
            "position", "name", shape.alias("shape"), kind.isin(*MUST_NOT_KINDS).alias("must_not"),
            "value", "lo", "hi"))).alias("all"))
        .filter(~F.col("faulty")).select("segment_id", "all"))


def _sides(rules: DataFrame) -> DataFrame:
    """The rules once for each should condition `c`, once with a NULL without any."""
    return rules.select("segment_id", "all", F.explode_outer(
        F.filter("all", lambda o: ~o["must_not"])).alias("c"))


def _beside(position: Column) -> Column:
    """The conditions of a rule other than the one of a position."""
    return F.filter("all", lambda o: position.isNull() | (o["position"] != position))


def _planned(rules: DataFrame, tags: DataFrame) -> _Plan:
    """The plan without bounds; at most a row for every two tags and their shapes is collected."""
    c, other = F.col("c"), F.col("other")
    found = (_sides(rules).select(
        F.coalesce(c["name"], F.lit("")).alias("name"), F.coalesce(c["shape"], F.lit("")).alias("shape"),
        _beside(c["position"]).alias("others"))
        .select("name", "shape", F.size("others").alias("n"), F.explode_outer("others").alias("other"))
        .groupBy("name", "shape", other["name"].alias("o_name"), other["shape"].alias("o_shape"))
        .agg(F.max("n").alias("n")).collect())
    others: dict[tuple[str, str], list[tuple[str, str]]] = {}
    most: dict[tuple[str, str], int] = {}
    for r in found:
        side = (r["name"], r["shape"])
        others.setdefault(side, [])
        most[side] = max(most.get(side, 0), r["n"])
        if r["o_name"] is not None:
            others[side].append((r["o_name"], r["o_shape"]))
    names = sorted({n for n, _ in others if n} | {n for found in others.values() for n, _ in found})
    return _Plan({n: i for i, n in enumerate(names)},
                 {n: _space(_element(tags.schema[n].dataType), n) for n in names}, {},
                 {k: sorted(v) for k, v in others.items()}, most)


def _kind_of(space: str) -> str:
    return dict(zip(_SPACES, ("bigint", "double", "string")))[space]


def _condition_rows(rules: DataFrame, plan: _Plan) -> DataFrame:
    """side (its number), level, key, segment_id, position, lo, hi and others of every key that a
    should condition asks for; `what` is the number of another condition's tag and shape."""
    c, name, shape = F.col("c"), F.col("name"), F.col("shape")
    what = {o: i for i, o in enumerate(plan.kinds)}

    def numbered(o: Column) -> Column:
        out = F.lit(None).cast("int")
        for (n, s), i in what.items():
            out = F.when((o["name"] == n) & (o["shape"] == s), i).otherwise(out)
        return F.struct(out.alias("what"), o["must_not"].alias("must_not"),
                        F.coalesce(o["position"] < c["position"], F.lit(False)).alias("earlier"),
                        o["value"].alias("value"), o["lo"].alias("lo"), o["hi"].alias("hi"))

    each = _sides(rules).select("segment_id", "c.*", F.transform(
        _beside(c["position"]), numbered).alias("others"))
    side = F.lit(None).cast("int")
    keys = F.array(F.struct(F.lit(0).alias("level"), F.when(
        shape == "match", F.coalesce(*(F.col("value")[s].cast("string") for s in _SPACES)))
        .otherwise("").alias("key")))
    for i, (n, s) in enumerate(plan.sides):
        here = name.isNull() if not n else (name == n) & (shape == s)
        side = F.when(here, i).otherwise(side)
        if s == "range":
            ends = []
            for v, open_end in ((F.col("lo"), 0), (F.col("hi"), len(plan.bounds[n]))):
                ends.append(F.when(_given(v), _bucket(v[plan.spaces[n]], plan.bounds[n], _kind_of(
                    plan.spaces[n]))).otherwise(open_end))
            keys = F.when(here, _nodes(*ends, _levels(plan.bounds[n]))).otherwise(keys)
    return (each.select(side.alias("side"), F.explode(keys).alias("k"), "segment_id", "position",
                        "lo", "hi", "others")
            .select("side", "k.level", "k.key", "segment_id", "position", "lo", "hi", "others"))


def _member_rows(people: DataFrame, side: tuple[str, str], plan: _Plan,
                 levels: list[int]) -> DataFrame:
    """key, memberId, phone and the tags of the side's others for every key that a member holds; for
    ranges also `x`, the value, and `before`, the member's next smaller one."""
    name, shape = side
    keep = ["memberId", "phone", *sorted({f"{'h' if s == 'exists' else 'v'}{plan.at[n]}"
                                          for n, s in plan.others[side]})]
    if not name:
        return people.select(F.lit("").alias("key"), *keep)
    i = plan.at[name]
    if shape == "exists":
        return people.filter(f"h{i}").select(F.lit("").alias("key"), *keep)
    if shape == "match":
        return (people.select(F.explode(f"v{i}").alias("x"), *keep)
                .select(F.col("x").cast("string").alias("key"), *keep))
    leaf = _bucket(F.col("x"), plan.bounds[name], _kind_of(plan.spaces[name]))
    return (people.select(F.posexplode(f"v{i}").alias("i", "x"), F.col(f"v{i}").alias("values"), *keep)
            .select("x", F.get("values", F.col("i") - 1).alias("before"), leaf.alias("leaf"), *keep)
            .select(F.explode(F.array(*(_node(F.col("leaf"), k) for k in levels))).alias("key"),
                    "x", "before", *keep))


def _within(v: Column, lo: Column, hi: Column) -> Column:
    """Is a value between bounds of its form (a missing bound is open)?"""
    return F.coalesce((lo.isNull() | (v >= lo)) & (hi.isNull() | (v <= hi)), F.lit(False))


def _any_within(values: Column, lo: Column, hi: Column) -> Column:
    """Does a sorted array hold a value between bounds (one may be missing)? Without a lambda, so
    that it stays in generated code: only if all lies around the range is the first value from `lo`
    on looked for, as the one behind `lo` in the array with `lo` added."""
    first, last = F.get(values, F.lit(0)), F.get(values, F.size(values) - 1)
    added = F.sort_array(F.array_append(values, lo))
    behind = F.get(added, F.array_position(added, lo).cast("int"))
    return (F.when(lo.isNull(), first <= hi).when(hi.isNull(), last >= lo)
            .when((first > hi) | (last < lo), F.lit(False))
            .when((first >= lo) | (last <= hi), F.lit(True)).otherwise(behind <= hi))


def _met(o: Callable[..., Column], side: tuple[str, str], plan: _Plan) -> Column:
    """Does the member meet another condition of the definition (`o` gives its fields), judged on
    the tags beside its key?"""
    out = F.lit(False)
    for n, shape in plan.others[side]:
        s, i = plan.spaces[n], plan.at[n]
        if shape == "exists":
            here = F.col(f"h{i}")
        elif shape == "match":
            here = F.array_contains(F.col(f"v{i}"), o("value", s))
        else:
            here = _any_within(F.col(f"v{i}"), o("lo", s), o("hi", s))
        out = F.when(o("what") == plan.kinds.index((n, shape)), F.coalesce(here, F.lit(False))
                     ).otherwise(out)
    return out


def _flat(asked: DataFrame, side: tuple[str, str], plan: _Plan) -> DataFrame:
    """The first other conditions as columns o<j>_..., which cost a pair less than an array."""
    fields = [("what",), *sorted({(f, plan.spaces[n]) for n, s in plan.others[side]
                                  for f in {"match": ("value",), "range": ("lo", "hi")}.get(s, ())})]
    out = []
    for j in range(plan.unrolled(side)):
        o = F.get("others", F.lit(j))
        bars = o["must_not"] | o["earlier"]
        out += [F.coalesce(bars, F.lit(False)).alias(f"o{j}_bars"),
                F.coalesce(~bars, F.lit(False)).alias(f"o{j}_adds"),
                *(_field(o, *f).alias("_".join((f"o{j}", *f))) for f in fields)]
    return asked.select("*", *out).drop("others")


def _field(o: Column, *path: str) -> Column:
    for name in path:
        o = o[name]
    return o


def _counted(keys: DataFrame, asked: DataFrame) -> DataFrame:
    """side, key, pairs and salts of every key that members hold and conditions ask for."""
    m, c = F.col("m"), F.col("c")
    salts = F.least(F.ceil(m / LEAST_MEMBERS),
                    F.greatest(F.ceil(m / PER_SALT), F.ceil(m * c / PAIRS))).cast("long")
    return (keys.groupBy("side", "key").agg(F.count(F.lit(1)).alias("m"))
            .join(asked.groupBy("side", "key").agg(F.count(F.lit(1)).alias("c")), ["side", "key"])
            .select("side", "key", (m * c).alias("pairs"), salts.alias("salts")))


def _joined(held: DataFrame, asked: DataFrame, salted: dict[str, int], pairs: int,
            one_key: bool) -> DataFrame:
    """Members and conditions of equal keys; `one_key` if there is only one."""
    on, spark = ["key"], held.sparkSession
    salt = F.pmod(F.xxhash64("memberId", "phone"), F.col("salts"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))
    if one_key:
        # A constant in place of the key would be folded, which leaves a join without a key.
        on, salts = ["salt"], F.lit(max([1, *salted.values()])).cast("long")
        held = held.drop("key").withColumn("salts", salts).withColumn("salt", salt).drop("salts")
        asked = asked.drop("key").withColumn("salts", salts).withColumn("salt", each).drop("salts")
    elif salted:
        on = ["key", "salt"]
        listed = F.broadcast(spark.createDataFrame(list(salted.items()), "key string, salts long"))
        held, asked = (df.join(listed, "key", "left").withColumn("salts", F.coalesce(
            "salts", F.lit(1).cast("long"))) for df in (held, asked))
        held, asked = held.withColumn("salt", salt).drop("salts"), asked.withColumn("salt", each).drop("salts")
    if pairs > PAIRS:
        # By its bytes such a join would get far too few tasks.
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * -(-pairs // PAIRS))
        held, asked = held.repartition(tasks, *on), asked.repartition(tasks, *on)
    return held.join(asked, on)


def _judged(met: DataFrame, side: tuple[str, str], plan: _Plan, unrolled: bool) -> DataFrame:
    """segment_id, memberId, phone, score of the joined rows that give a pair."""
    name, shape = side
    if shape == "range":
        lo, hi = F.col("lo"), F.col("hi")
        # An array can meet one range several times: its smallest value there counts.
        met = met.filter(_within(F.col("x"), lo, hi)
                         & (F.col("before").isNull() | ~_within(F.col("before"), lo, hi)))
    score = F.lit(1 if name else 0)
    if plan.others[side] and unrolled:
        for j in range(plan.unrolled(side)):
            found = _met(lambda *f: F.col("_".join((f"o{j}", *f))), side, plan)
            met = met.filter(~(F.col(f"o{j}_bars") & found))
            if name:
                score = score + (F.col(f"o{j}_adds") & found).cast("int")
    elif plan.others[side]:
        def bars(o: Column) -> Column:
            return (o["must_not"] | o["earlier"]) & _met(partial(_field, o), side, plan)

        def adds(o: Column) -> Column:
            return ~(o["must_not"] | o["earlier"]) & _met(partial(_field, o), side, plan)
        met = met.filter(~F.exists("others", bars))
        if name:
            score = score + F.size(F.filter("others", adds))
    return met.select("segment_id", "memberId", "phone", score.alias("score"))


def segment_from_table(tags: DataFrame, definitions: DataFrame) -> DataFrame:
    """segment_id, memberId, phone, score of every member of every defined segment.

    Same audiences and scores as `segment_batch`. The parsed definitions, the members' values, the
    keyed conditions and the counts of keys are written. Definitions may repeat a segment_id; each
    row is judged by itself, equal rows once. Members are told apart by (memberId, phone).
    """
    spark = tags.sparkSession
    rules = written(_rules(definitions, tags.schema), "rules")
    plan = _planned(rules, tags)
    people = written(_people(tags, list(plan.at)), "members")
    plan.bounds.update(_bounds(people, {n: plan.at[n] for n, s in plan.sides if s == "range"}))

    rows = _condition_rows(rules, plan)
    path = shared_folder(spark, "condition-keys")
    rows.write.partitionBy("side").parquet(path)
    asked = spark.read.schema(rows.schema).parquet(path)
    levels: dict[int, list[int]] = {}
    for r in asked.select("side", "level").distinct().collect():
        levels.setdefault(r["side"], []).append(r["level"])
    held = {i: _member_rows(people, plan.sides[i], plan, sorted(found))
            for i, found in sorted(levels.items())}
    if not held:
        return _nobody(tags, definitions)
    keys = None
    for i, found in held.items():
        part = found.select(F.lit(i).alias("side"), "key")
        keys = part if keys is None else keys.unionByName(part)
    counted = written(_counted(keys, asked), "key-counts")
    pairs = {r["side"]: r["n"] for r in
             counted.groupBy("side").agg(F.sum("pairs").alias("n")).collect()}
    salted: dict[int, dict[str, int]] = {}
    for r in counted.filter("salts > 1").orderBy(F.desc("pairs")).limit(SALTED).collect():
        salted.setdefault(r["side"], {})[r["key"]] = r["salts"]

    out = None
    for i, found in held.items():
        if i not in pairs:
            continue
        side, mine = plan.sides[i], asked.filter(F.col("side") == i).drop("side", "level")
        most, many = plan.unrolled(side), F.size("others") > plan.unrolled(side)
        mine = mine.withColumns({c: F.col(c)[plan.spaces[side[0]]] for c in ("lo", "hi")}) \
            if side[1] == "range" else mine.drop("lo", "hi")
        halves = [(mine, True)] if plan.most[side] == most else [
            (mine.filter(~many), True), (mine.filter(many), False)]
        for half, unrolled in halves:
            if unrolled:
                half = _flat(half, side, plan)
            met = _joined(found, half, salted.get(i, {}), pairs[i], side[1] in ("", "exists"))
            part = _judged(met, side, plan, unrolled)
            out = part if out is None else out.unionByName(part)
    return out if out is not None else _nobody(tags, definitions)


def _nobody(tags: DataFrame, definitions: DataFrame) -> DataFrame:
    """The result without a row."""
    return tags.sparkSession.createDataFrame([], T.StructType(
        [definitions.schema["segment_id"], tags.schema["memberId"], tags.schema["phone"],
         T.StructField("score", T.IntegerType(), False)]))
