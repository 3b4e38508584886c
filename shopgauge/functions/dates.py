"""Date text as column expressions: detect the style of a date string, parse, format, shift,
take parts, and count days between dates.

Parsing is strict: a value matches a style only when the whole text fits it, fields are zero-padded
and in range, so at most one of the styles matches and detection does not depend on the clock. Text
that fits no style gives NULL everywhere. The style is found from the text's shape, its digits
masked; then its fields are put in full and parsed once. Reports with several outputs decode a
column first (`decoded`).
Styles without a year take 1970; styles without a date take 1970-01-01.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import DATE_PATTERNS, DAY_FORMAT, WEEK

PATTERNS = DATE_PATTERNS

STAMP = "yyyy-MM-dd HH:mm:ss"
DAY = DAY_FORMAT
TIME = "HH:mm:ss"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _case(cases: list[tuple[Column, Column]]) -> Column:
    out = None
    for cond, value in cases:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out


# Fields of a full time: token, and what stands for a field that a style lacks.
_FIELDS = [("yyyy", "1970"), ("MM", "01"), ("dd", "01"), ("HH", "00"), ("mm", "00"), ("ss", "00")]


def _shape(style: str) -> str:
    """A style's text with every digit as 0."""
    for token, _ in _FIELDS:
        style = style.replace(token, "0" * len(token))
    return style


SHAPES = [_shape(p) for p in PATTERNS]


def _masked(t: Column) -> Column:
    """The text's shape: the digits are masked; each style has a shape of its own."""
    return F.translate(t, "123456789", "0" * 9)


def _style_number(t: Column) -> Column:
    """Which style the text is laid out in (its fields may still be out of range), or NULL."""
    return _case([(_masked(t) == own, F.lit(i)) for i, own in enumerate(SHAPES)])


def _time(t: Column, layout: Column, layouts: list) -> Column:
    """The time of a text by its layout, which is one of `layouts` (a value for each style).

    Every field has its place in the text, which styles that differ in their separators share; put
    in full, as `yyyy-MM-dd HH:mm:ss`, the text is parsed once.
    """
    places: dict[tuple, list] = {}
    for p, own in zip(PATTERNS, layouts):
        places.setdefault(tuple(p.find(token) for token, _ in _FIELDS), []).append(own)

    def full(at: tuple) -> Column:
        y, mo, d, h, mi, s = (F.lit(missing) if k < 0 else F.substring(t, k + 1, len(token))
                              for k, (token, missing) in zip(at, _FIELDS))
        dash, colon = F.lit("-"), F.lit(":")
        return F.concat(y, dash, mo, dash, d, F.lit(" "), h, colon, mi, colon, s)
    return F.try_to_timestamp(_case([(layout.isin(own), full(at)) for at, own in places.items()]),
                              F.lit(STAMP))


def decoded(df: DataFrame, txt: str = "txt") -> DataFrame:
    """The frame with `style_number` (NULL if the text is no date) and `time` of its date text: each
    value is looked at and parsed once, whatever is made of the two columns afterwards."""
    t, number = F.col(txt), F.col("style_number")
    return (df.withColumn("style_number", _style_number(t))
            .withColumn("time", _time(t, number, list(range(len(PATTERNS)))))
            .withColumn("style_number", F.when(F.col("time").isNotNull(), number)))


def _style_name(number: Column) -> Column:
    return _case([(number == i, F.lit(p)) for i, p in enumerate(PATTERNS)])


# D2 / D1
def detect_style(txt: str | Column) -> Column:
    """The style the text is written in, or NULL."""
    t = _col(txt)
    return F.when(parse_date(t).isNotNull(),
                  _case([(_masked(t) == own, F.lit(p)) for p, own in zip(PATTERNS, SHAPES)]))


def is_date(txt: str | Column) -> Column:
    return parse_date(txt).isNotNull()


# D3
def parse_date(txt: str | Column, style: str | None = None) -> Column:
    """Timestamp of the text, in the given style or in whichever style fits."""
    t = _col(txt)
    if style is not None:
        return F.try_to_timestamp(t, F.lit(style))
    return _time(t, _masked(t), SHAPES)


# D4
def format_date(ts: str | Column, style: str = STAMP) -> Column:
    return F.date_format(_col(ts), style)


# D5
def reformat(txt: str | Column, out_style: str = STAMP, in_style: str | None = None) -> Column:
    return format_date(parse_date(txt, in_style), out_style)


# D6-D11
def add_years(ts: str | Column, n: int) -> Column:
    return _col(ts) + F.make_ym_interval(F.lit(n), F.lit(0))


def add_months(ts: str | Column, n: int) -> Column:
    return _col(ts) + F.make_ym_interval(F.lit(0), F.lit(n))


def add_days(ts: str | Column, n: int) -> Column:
    return _col(ts) + F.make_dt_interval(F.lit(n))


def add_hours(ts: str | Column, n: int) -> Column:
    return _col(ts) + F.make_dt_interval(F.lit(0), F.lit(n))


def add_minutes(ts: str | Column, n: int) -> Column:
    return _col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n))


def add_seconds(ts: str | Column, n: int) -> Column:
    return _col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n))


SHIFTS = {"year": add_years, "month": add_months, "day": add_days, "hour": add_hours,
          "minute": add_minutes, "second": add_seconds}


# D12
def shift_text(txt: str | Column, n: int, unit: str = "day") -> Column:
    """Shift date text by `n` units and write it back in its own style."""
    t = _col(txt)
    return _in_style(SHIFTS[unit](parse_date(t), n), _masked(t), SHAPES)


def _in_style(ts: Column, layout: Column, layouts: list) -> Column:
    return _case([(layout == own, F.date_format(ts, p)) for p, own in zip(PATTERNS, layouts)])


# D13-D21
def year(ts: str | Column) -> Column:
    return F.year(_col(ts))


def month(ts: str | Column, zero_based: bool = False) -> Column:
    m = F.month(_col(ts))
    return m - 1 if zero_based else m


def day(ts: str | Column) -> Column:
    return F.dayofmonth(_col(ts))


def hour(ts: str | Column) -> Column:
    return F.hour(_col(ts))


def minute(ts: str | Column) -> Column:
    return F.minute(_col(ts))


def second(ts: str | Column) -> Column:
    return F.second(_col(ts))


def date_text(ts: str | Column) -> Column:
    return F.date_format(_col(ts), DAY)


def time_text(ts: str | Column) -> Column:
    return F.date_format(_col(ts), TIME)


# D22
def weekday_number(ts: str | Column) -> Column:
    """ISO weekday: 1 = Monday ... 7 = Sunday."""
    return F.weekday(_col(ts)) + 1


def _week_lookup(ts: str | Column, pos: int) -> Column:
    names = F.create_map(*[x for w in WEEK for x in (F.lit(w[0]), F.lit(w[pos]))])
    return F.element_at(names, weekday_number(ts))


def weekday_cn(ts: str | Column) -> Column:
    return _week_lookup(ts, 1)


def weekday_en(ts: str | Column) -> Column:
    return _week_lookup(ts, 2)


def weekday_short(ts: str | Column) -> Column:
    return _week_lookup(ts, 3)


# D23
def interval_days(a: str | Column, b: str | Column) -> Column:
    """Whole calendar days between two dates, timestamps or date texts of any style, never
    negative; NULL where a side is NULL or a text fits no style."""
    return F.abs(F.datediff(F.to_date(_moment(a)), F.to_date(_moment(b))))


def _moment(c: str | Column) -> Column:
    """A date or timestamp as it is, a text parsed in its style (the test is constant-folded)."""
    c = _col(c)
    return F.when(F.typeof(c) == "string", parse_date(c.cast("string"))).otherwise(
        c.try_cast("timestamp"))


# ---------------------------------------------------------------------------------------------
# Reports over a frame with a date-text column `txt`.

def styled_event_dates(events: DataFrame) -> DataFrame:
    """event_id, txt: each event time written in style number `event_id % 23`."""
    idx = F.col("event_id") % len(PATTERNS)
    txt = _case([(idx == i, F.date_format("ts", p)) for i, p in enumerate(PATTERNS)])
    return events.select("event_id", txt.alias("txt"))


def date_normalize_report(df: DataFrame) -> DataFrame:
    return decoded(df).select(
        "event_id", "txt", _style_name(F.col("style_number")).alias("style"),
        F.col("style_number").isNotNull().alias("is_date"),
        format_date("time", STAMP).alias("normalized"), format_date("time", DAY).alias("day"))


def date_shift_report(df: DataFrame, n: int) -> DataFrame:
    return decoded(df).select(
        "event_id", "txt",
        *[format_date(fn("time", n), STAMP).alias(f"plus_{unit}s") for unit, fn in SHIFTS.items()],
        _in_style(add_days("time", n), F.col("style_number"), list(range(len(PATTERNS))))
        .alias("shifted_text"))


def date_parts_report(df: DataFrame) -> DataFrame:
    ts = "time"
    return decoded(df).select(
        "event_id", "txt", year(ts).alias("year"), month(ts).alias("month"),
        day(ts).alias("day"), hour(ts).alias("hour"), minute(ts).alias("minute"),
        second(ts).alias("second"), date_text(ts).alias("date_text"),
        time_text(ts).alias("time_text"), weekday_number(ts).alias("weekday"),
        weekday_cn(ts).alias("week_cn"), weekday_en(ts).alias("week_en"),
        weekday_short(ts).alias("week_short"))


def date_interval_report(df: DataFrame, as_of: dt.date) -> DataFrame:
    return decoded(df).select("event_id", "txt",
                              interval_days("time", F.lit(as_of)).alias("days"))
