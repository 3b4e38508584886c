"""Audience conditions -> Spark Columns.

A condition is `{"name": tag column, "value": text, "type": kind}`; kinds:
  match      (should)    tag equals value; on an array tag, any element equals it
  notMatch   (must not)  the negation of match; a member without the tag is kept
  rangeBoth  (should)    lo <= tag <= hi; bounds as "lo"/"hi" keys (one may be missing), a
             [lo, hi] pair, or "lo-hi"
  rangeGte   (should)    tag >= value
  rangeLte   (should)    tag <= value
  exists     (should)    tag is present (not NULL; an array must be non-empty)

Combination: with at least one should condition a member must meet one of them; must-not
conditions exclude; with none at all every member matches. The score is the number of should
conditions met. Every leaf is NULL-safe (a missing tag is "not met"), so NULL never drops a row
from the must-not side. Values are typed by the tag column's data type on the driver, before
the plan is built; text that does not fit the type is rejected with ValueError.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
from dataclasses import dataclass
from typing import Any, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHOULD_KINDS = ("match", "rangeBoth", "rangeGte", "rangeLte", "exists")
MUST_NOT_KINDS = ("notMatch",)
KINDS = SHOULD_KINDS + MUST_NOT_KINDS


@dataclass(frozen=True)
class Condition:
    name: str
    type: str
    value: Any = None
    lo: Any = None
    hi: Any = None

    def __post_init__(self) -> None:
        if self.type not in KINDS:
            raise ValueError(f"unknown condition type {self.type!r} (expected one of {KINDS})")
        if self.type in ("match", "notMatch", "rangeGte", "rangeLte") and self.value is None:
            raise ValueError(f"{self.type} on {self.name!r} needs a value")

    @staticmethod
    def of(obj: "Condition | Mapping[str, Any] | tuple") -> "Condition":
        if isinstance(obj, Condition):
            return obj
        if isinstance(obj, tuple):
            obj = dict(zip(("name", "value", "type"), obj))
        return Condition(name=obj["name"], type=obj.get("type"), value=obj.get("value"),
                         lo=obj.get("lo"), hi=obj.get("hi"))


def parse_request(body: str | Mapping[str, Any]) -> list[Condition]:
    """Conditions from a request body `{"selectedTags": [{name, value, type}, ...]}`; the key must
    be there (an empty list means everyone, a missing one is a mistake)."""
    data = json.loads(body) if isinstance(body, str) else body
    if not isinstance(data, Mapping) or not isinstance(data.get("selectedTags"), list):
        raise ValueError("a request body needs a list of conditions under 'selectedTags'")
    return [Condition.of(c) for c in data["selectedTags"]]


def _range_bounds(c: Condition) -> tuple[Any, Any]:
    if c.lo is not None or c.hi is not None:
        return c.lo, c.hi
    if isinstance(c.value, (list, tuple)) and len(c.value) == 2 and any(
            v is not None for v in c.value):
        return c.value[0], c.value[1]
    if isinstance(c.value, str):
        parts = c.value.split("-")
        if len(parts) == 2 and parts[0] != "" and parts[1] != "":
            return parts[0], parts[1]
    raise ValueError(f"rangeBoth on {c.name!r}: cannot read two bounds from {c.value!r}; "
                     "pass lo and hi explicitly")


def _typed(value: Any, dtype: T.DataType, name: str) -> Column:
    """A literal of the column's type, converted on the driver (bad text fails here)."""
    try:
        if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            v = int(str(value).strip())
        elif isinstance(dtype, (T.FloatType, T.DoubleType)):
            v = float(str(value).strip())
        elif isinstance(dtype, T.DecimalType):
            v = decimal.Decimal(str(value).strip())
        elif isinstance(dtype, T.BooleanType):
            text = str(value).strip().lower()
            if text not in ("true", "false"):
                raise ValueError(text)
            v = text == "true"
        elif isinstance(dtype, T.DateType):
            v = dt.date.fromisoformat(str(value).strip())
        elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            # Cast from ISO text: no dependence on the Python process's local zone.
            return F.lit(dt.datetime.fromisoformat(str(value).strip()).isoformat(sep=" ")
                         ).cast(dtype)
        else:
            v = str(value)
    except (ValueError, decimal.InvalidOperation) as exc:
        raise ValueError(f"value {value!r} does not fit column {name!r} of type "
                         f"{dtype.simpleString()}") from exc
    return F.lit(v).cast(dtype)


def _leaf(c: Condition, schema: T.StructType) -> Column:
    if c.name not in schema.fieldNames():
        raise ValueError(f"unknown tag {c.name!r}")
    dtype = schema[c.name].dataType
    col = F.col(c.name)
    is_array = isinstance(dtype, T.ArrayType)
    elem = dtype.elementType if is_array else dtype

    def test(pred) -> Column:
        return F.exists(col, pred) if is_array else pred(col)

    if c.type in ("match", "notMatch"):
        v = _typed(c.value, elem, c.name)
        leaf = F.array_contains(col, v) if is_array else (col == v)
    elif c.type == "rangeBoth":
        lo, hi = _range_bounds(c)
        # One bound alone is a one-sided range.
        lo_v = None if lo is None else _typed(lo, elem, c.name)
        hi_v = None if hi is None else _typed(hi, elem, c.name)
        if lo_v is None:
            leaf = test(lambda x: x <= hi_v)
        elif hi_v is None:
            leaf = test(lambda x: x >= lo_v)
        else:
            leaf = test(lambda x: (x >= lo_v) & (x <= hi_v))
    elif c.type == "rangeGte":
        v = _typed(c.value, elem, c.name)
        leaf = test(lambda x: x >= v)
    elif c.type == "rangeLte":
        v = _typed(c.value, elem, c.name)
        leaf = test(lambda x: x <= v)
    else:  # exists
        leaf = col.isNotNull() & (F.size(col) > 0) if is_array else col.isNotNull()
    return F.coalesce(leaf, F.lit(False))


def compile_conditions(conditions: Iterable, schema: T.StructType) -> tuple[Column, Column]:
    """(matched, score) Columns for a list of conditions over a frame with `schema`."""
    conds = [Condition.of(c) for c in conditions]
    should = [_leaf(c, schema) for c in conds if c.type in SHOULD_KINDS]
    must_not = [_leaf(c, schema) for c in conds if c.type in MUST_NOT_KINDS]
    matched = F.lit(True)
    if should:
        matched = _any(should)
    if must_not:
        matched = matched & ~_any(must_not)
    score = F.lit(0)
    for leaf in should:
        score = score + leaf.cast("int")
    return matched, score


def _any(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out | c
    return out
