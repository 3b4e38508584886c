"""Oracle SQL for every registered query, runnable by DuckDB on the raw test tables.

Each statement inlines the shop adapter views it needs as CTEs, then states the report in plain
SQL (correlated subqueries and brute-force formulations where that is clearer), written apart
from the DataFrame code so the two can check each other.
"""

from __future__ import annotations

import datetime as dt
import re

from ..functions.dates import PATTERNS, WEEK
from . import params as P

VIEWS = {
    "t_member": """SELECT c.c_custkey AS id,
       CASE WHEN c.c_acctbal < 0 THEN 'null' ELSE c.c_name END AS phone,
       c.c_mktsegment AS sex,
       c.c_nationkey AS member_channel,
       CASE WHEN c.c_custkey % 3 = 0 THEN 'null' ELSE c.c_name END AS mp_open_id,
       c.c_nationkey AS address_default_id,
       f.first_time AS create_time
FROM customer c
LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_time FROM orders GROUP BY o_custkey) f
  ON c.c_custkey = f.o_custkey""",
    "t_order": """SELECT o_orderkey AS order_id, o_custkey AS member_id,
       CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 3 END AS order_status,
       CAST(o_totalprice AS DECIMAL(18,2)) AS origin_price,
       CAST(o_totalprice AS DECIMAL(18,2)) AS pay_price,
       o_orderdate AS create_time
FROM orders""",
    "t_order_commodity": "SELECT l_orderkey AS order_id, l_partkey AS commodity_id FROM lineitem",
    "t_coupon": "SELECT p_partkey AS id, CAST(p_retailprice AS DECIMAL(18,2)) AS coupon_price "
                "FROM part",
    "t_coupon_member": """SELECT user_id AS member_id,
       CASE WHEN event_type = 'signup' THEN 1 ELSE 2 + event_id % 100 END AS coupon_id,
       1 + event_id % 2 AS coupon_channel,
       ts AS create_time
FROM events WHERE event_type IN ('signup', 'purchase')""",
    "t_delivery": """SELECT o.o_custkey AS member_id, o.o_orderdate AS pick_time,
       l.l_shipdate AS arrive_time
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""",
    "t_feedback": """SELECT event_id AS id, user_id AS member_id, event_id % 5 AS feedback_type
FROM events WHERE event_type IN ('error', 'click')""",
    "t_line": "SELECT concat_ws(chr(9), CAST(doc_id AS VARCHAR), source, lang) AS line "
              "FROM documents",
}


def _ts(d: dt.date) -> str:
    return f"TIMESTAMP '{d.isoformat()} 00:00:00'"


def _day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def with_views(body: str, ctes: list[tuple[str, str]] = ()) -> str:
    """`WITH <adapter views used> , <extra ctes> <body>`."""
    text = body + " ".join(sql for _, sql in ctes)
    used = []
    for name in VIEWS:
        if re.search(rf"\b{name}\b", text):
            used.append(name)
    parts = [f"{n} AS ({VIEWS[n]})" for n in used] + [f"{n} AS ({sql})" for n, sql in ctes]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body


# ------------------------------------------------------------------------------ members
MEMBER_SEX = with_views(
    'SELECT sex AS "memberSex", count(id) AS "sexCount" FROM t_member GROUP BY sex')
MEMBER_CHANNEL = with_views(
    'SELECT member_channel AS "memberChannel", count(id) AS "channelCount" '
    'FROM t_member GROUP BY member_channel')
MEMBER_MP_SUB = with_views(
    """SELECT count(*) FILTER (WHERE mp_open_id <> 'null') AS "subCount",
              count(*) FILTER (WHERE mp_open_id = 'null') AS "unsubCount" FROM t_member""")
_HEAT_PARTS = [
    ("hc", "SELECT count(DISTINCT member_id) AS coupon FROM t_coupon_member"),
    ("hr", """SELECT count(*) FILTER (WHERE phone = 'null') AS reg,
                     count(*) FILTER (WHERE phone <> 'null') AS complete FROM t_member"""),
    ("ho", """SELECT count(*) FILTER (WHERE n = 1) AS "order",
                     count(*) FILTER (WHERE n >= 2) AS "orderAgain"
              FROM (SELECT member_id, count(order_id) AS n FROM t_order GROUP BY member_id) t"""),
]
MEMBER_HEAT = with_views(
    'SELECT hc.coupon, hr.reg, hr.complete, ho."order", ho."orderAgain" FROM hc, hr, ho',
    _HEAT_PARTS)
MEMBER_PROFILE_JSON = with_views(
    """SELECT CAST(to_json({
        'memberSexes': (SELECT list({'memberSex': sex, 'sexCount': n} ORDER BY sex, n)
                        FROM (SELECT sex, count(id) AS n FROM t_member GROUP BY sex)),
        'memberChannels': (SELECT list({'memberChannel': ch, 'channelCount': n} ORDER BY ch, n)
                           FROM (SELECT member_channel AS ch, count(id) AS n
                                 FROM t_member GROUP BY member_channel)),
        'memberMpSubs': (SELECT [{'subCount': count(*) FILTER (WHERE mp_open_id <> 'null'),
                                  'unsubCount': count(*) FILTER (WHERE mp_open_id = 'null')}]
                         FROM t_member),
        'memberHeats': (SELECT {'reg': hr.reg, 'complete': hr.complete, 'order': ho."order",
                                'orderAgain': ho."orderAgain", 'coupon': hc.coupon}
                        FROM hc, hr, ho)
       }) AS VARCHAR) AS profile""",
    _HEAT_PARTS)

# ------------------------------------------------------------------------------ funnel
_REPEAT = ("SELECT member_id FROM t_order WHERE order_status = 2 "
           "GROUP BY member_id HAVING count(order_id) > 1")
REPEAT_BUYERS = with_views(_REPEAT)
FUNNEL_COUNTS = with_views(
    f"""SELECT CAST(1000 AS BIGINT) AS present, CAST(800 AS BIGINT) AS click,
       CAST(600 AS BIGINT) AS "addCart",
       (SELECT count(*) FROM (SELECT DISTINCT member_id FROM t_order WHERE order_status = 2))
         AS "order",
       (SELECT count(*) FROM ({_REPEAT})) AS "orderAgain",
       (SELECT count(*) FROM (SELECT DISTINCT member_id FROM t_coupon_member
                              WHERE coupon_channel = 1) c
          JOIN ({_REPEAT}) a ON c.member_id = a.member_id) AS "chargeCoupon" """)

# ------------------------------------------------------------------------------ growth
def _growth_daily(as_of: dt.date) -> str:
    lower = _ts(as_of - dt.timedelta(days=7))
    return with_views(
        f"""SELECT m.day, m."regCount", m."memberCount", o."orderCount",
       CAST(p.prior + sum(o.g) OVER (ORDER BY m.day ROWS BETWEEN UNBOUNDED PRECEDING
                                     AND CURRENT ROW) AS DOUBLE) AS gmv
FROM gm m JOIN go o ON m.day = o.day CROSS JOIN gp p""",
        [("gm", f"""SELECT {_day('create_time')} AS day, count(id) AS "regCount",
                     max(id) AS "memberCount" FROM t_member
                     WHERE create_time >= {lower} GROUP BY 1"""),
         ("go", f"""SELECT {_day('create_time')} AS day, max(order_id) AS "orderCount",
                     sum(origin_price) AS g FROM t_order
                     WHERE create_time >= {lower} GROUP BY 1"""),
         ("gp", f"""SELECT coalesce(sum(origin_price), 0) AS prior FROM t_order
                     WHERE create_time < {lower}""")])


def _calendar(first: dt.date, last: dt.date) -> str:
    return (f"SELECT d FROM generate_series({_ts(first)}, {_ts(last)}, INTERVAL 1 DAY) "
            f"AS g(d)")


def _growth_calendar(as_of: dt.date) -> str:
    first, last = as_of - dt.timedelta(days=7), as_of - dt.timedelta(days=1)
    return with_views(
        f"""SELECT {_day('d')} AS day,
       (SELECT count(id) FROM t_member WHERE create_time >= d
          AND create_time < d + INTERVAL 1 DAY) AS "regCount",
       (SELECT count(id) FROM t_member WHERE create_time < d + INTERVAL 1 DAY) AS "memberCount",
       (SELECT count(order_id) FROM t_order WHERE create_time < d + INTERVAL 1 DAY)
         AS "orderCount",
       (SELECT CAST(coalesce(sum(origin_price), 0) AS DOUBLE) FROM t_order
          WHERE create_time < d + INTERVAL 1 DAY) AS gmv
FROM cal""",
        [("cal", _calendar(first, last))])


def _wow_daily(table: str, id_col: str, out: str, as_of: dt.date) -> str:
    return with_views(
        f"""SELECT {_day('create_time')} AS day, count({id_col}) AS "{out}" FROM {table}
WHERE create_time >= {_ts(as_of - dt.timedelta(days=14))} AND create_time < {_ts(as_of)}
GROUP BY 1""")


def _wow_compare(table: str, id_col: str, as_of: dt.date) -> str:
    first, last = as_of - dt.timedelta(days=7), as_of - dt.timedelta(days=1)
    return with_views(
        f"""SELECT {_day('d')} AS day, CAST(isodow(d) AS INTEGER) AS weekday, n, prev_n,
       CASE WHEN prev_n = 0 THEN NULL ELSE (n - prev_n) / prev_n END AS wow
FROM (SELECT d,
        (SELECT count({id_col}) FROM {table} WHERE create_time >= d
           AND create_time < d + INTERVAL 1 DAY) AS n,
        (SELECT count({id_col}) FROM {table} WHERE create_time >= d - INTERVAL 7 DAY
           AND create_time < d - INTERVAL 6 DAY) AS prev_n
      FROM cal) x""",
        [("cal", _calendar(first, last))])


def _remind(where: str, out: str, as_of: dt.date) -> str:
    return with_views(
        f"""SELECT {_day('create_time')} AS day, count(member_id) AS "{out}"
FROM t_coupon_member WHERE {where} AND create_time >= {_ts(as_of - dt.timedelta(days=7))}
GROUP BY 1""")


# ------------------------------------------------------------------------------ words
HOT_FIELD_TOP10 = with_views(
    r"""SELECT word, count(*) AS count
FROM (SELECT string_split(regexp_replace(line, '\t+$', ''), chr(9))[3] AS word FROM t_line) w
WHERE word IS NOT NULL GROUP BY word ORDER BY count DESC, word LIMIT 10""")
HOT_FIELD_REJECTS = with_views(
    r"""SELECT count(*) AS lines, count(*) FILTER (WHERE word IS NULL) AS rejected
FROM (SELECT string_split(regexp_replace(line, '\t+$', ''), chr(9))[3] AS word FROM t_line) w""")
HOT_FIELD_FILE = with_views(
    r"""SELECT word, count(*) AS count, word IS NULL AS rejected
FROM (SELECT string_split(regexp_replace(line, '\t+$', ''), chr(9))[3] AS word FROM t_line) w
GROUP BY word""")
HOT_TOKENS_TOP10 = r"""SELECT word, count(*) AS count
FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS word FROM documents) w
WHERE word <> '' GROUP BY word ORDER BY count DESC, word LIMIT 10"""

# ------------------------------------------------------------------------------ tags
_BASE = f"""SELECT id AS "memberId", phone, sex, member_channel AS channel,
       mp_open_id AS "subOpenId", address_default_id AS address,
       {_day('create_time')} AS "regTime" FROM t_member"""
_ORDER_EXACT_CTES = [
    ("os", """SELECT member_id, count(order_id) AS c, max(create_time) AS t,
                     sum(pay_price) AS m FROM t_order GROUP BY member_id"""),
    ("og", """SELECT o.member_id, list_sort(list(DISTINCT oc.commodity_id)) AS goods
              FROM t_order o JOIN t_order_commodity oc ON o.order_id = oc.order_id
              WHERE oc.commodity_id IS NOT NULL GROUP BY o.member_id"""),
]
# An order with k lines weighs k, one without lines weighs 1.
_ORDER_LITERAL_CTES = [
    ("line_n", "SELECT order_id, count(*) AS k FROM t_order_commodity GROUP BY order_id"),
    ("weighted", """SELECT member_id, create_time, coalesce(k, 1) * pay_price AS money,
                           CASE WHEN order_id IS NULL THEN 0 ELSE coalesce(k, 1) END AS w
                    FROM t_order LEFT JOIN line_n USING (order_id)"""),
    _ORDER_EXACT_CTES[1],
]
_ORDER_LITERAL = f"""SELECT weighted.member_id AS "memberId",
       CAST(sum(w) AS BIGINT) AS "orderCount", {_day('max(create_time)')} AS "orderTime",
       CAST(sum(money) AS DOUBLE) AS "orderMoney", coalesce(any_value(goods), []) AS "favGoods"
FROM weighted LEFT JOIN og ON og.member_id IS NOT DISTINCT FROM weighted.member_id
GROUP BY weighted.member_id"""
_ORDER_EXACT = f"""SELECT os.member_id AS "memberId", os.c AS "orderCount",
       {_day('os.t')} AS "orderTime", CAST(os.m AS DOUBLE) AS "orderMoney",
       coalesce(og.goods, []) AS "favGoods"
FROM os LEFT JOIN og ON os.member_id IS NOT DISTINCT FROM og.member_id"""
_FREE = f"""SELECT member_id AS "memberId", {_day('create_time')} AS "freeCouponTime"
FROM t_coupon_member WHERE coupon_id = 1"""
_FREE_FIRST = f"""SELECT member_id AS "memberId", min({_day('create_time')}) AS "freeCouponTime"
FROM t_coupon_member WHERE coupon_id = 1 GROUP BY member_id"""
_COUPON_TIMES = f"""SELECT member_id AS "memberId",
       coalesce(list_sort(list({_day('create_time')}) FILTER (WHERE create_time IS NOT NULL)), [])
         AS "couponTimes"
FROM t_coupon_member WHERE coupon_id <> 1 GROUP BY member_id"""
_CHARGE = """SELECT member_id AS "memberId", CAST(sum(n * price) AS DOUBLE) / 2 AS "chargeMoney"
FROM (SELECT member_id, coupon_id, count(*) AS n FROM t_coupon_member
      WHERE coupon_channel <> 1 GROUP BY ALL) bought
LEFT JOIN (SELECT id AS coupon_id, coupon_price AS price FROM t_coupon) USING (coupon_id)
GROUP BY member_id"""
_OVER_TIME = """SELECT member_id AS "memberId",
       CAST(floor(epoch(max(arrive_time))) AS BIGINT)
         - CAST(floor(epoch(max(pick_time))) AS BIGINT) AS "overTime"
FROM t_delivery GROUP BY member_id"""
_FEEDBACK = """SELECT member_id AS "memberId", arg_max(feedback_type, id) AS "feedBack"
FROM t_feedback GROUP BY member_id"""


def _looked_up(col: str, cte: str) -> str:
    """A member's only value in a one-row-per-member CTE."""
    return f'(SELECT x."{col}" FROM {cte} x WHERE x."memberId" = tb."memberId") AS "{col}"'


# One row per member and free coupon; everything else is looked up by member.
_WIDE_SELECT = f"""SELECT "memberId", phone, sex, channel, "subOpenId", address, "regTime",
       "freeCouponTime", {', '.join(_looked_up(c, 'tob') for c in
                                    ('orderCount', 'orderTime', 'orderMoney', 'favGoods'))},
       {_looked_up('couponTimes', 'tct')}, {_looked_up('chargeMoney', 'tcm')},
       {_looked_up('overTime', 'tot')}, {_looked_up('feedBack', 'tfb')}
FROM tfc RIGHT JOIN tb USING ("memberId")"""

_COMMON_TAG_CTES = [("tb", _BASE), ("tct", _COUPON_TIMES), ("tcm", _CHARGE),
                    ("tot", _OVER_TIME), ("tfb", _FEEDBACK)]
USER_TAGS_LITERAL_CTES = (_COMMON_TAG_CTES + _ORDER_LITERAL_CTES
                          + [("tob", _ORDER_LITERAL), ("tfc", _FREE)])
USER_TAGS_CTES = (_COMMON_TAG_CTES + _ORDER_EXACT_CTES
                  + [("tob", _ORDER_EXACT), ("tfc", _FREE_FIRST), ("user_tags", _WIDE_SELECT)])

# ------------------------------------------------------------------------------ segments
# The registered segment conditions, written out as SQL predicates over the tag table.
_SEGMENT_SELECT_WHERE = """(sex = 'BUILDING' OR "orderCount" BETWEEN 12 AND 14
   OR list_contains("favGoods", 7) OR "chargeMoney" >= 1000 OR "overTime" <= 1000000
   OR "feedBack" IS NOT NULL)
  AND NOT coalesce(channel = 3, false)"""


def _audience(where: str) -> str:
    return with_views(f'SELECT "memberId", phone FROM user_tags WHERE {where}', USER_TAGS_CTES)


SEGMENT_SELECT = _audience(_SEGMENT_SELECT_WHERE)
SEGMENT_EXPORT = with_views(
    f"""SELECT '[' || CAST("memberId" AS VARCHAR) || ',' || coalesce(phone, 'null') || ']' AS line
FROM user_tags WHERE {_SEGMENT_SELECT_WHERE}""", USER_TAGS_CTES)
SEGMENT_EXCLUDE_ONLY = _audience(
    "NOT coalesce(sex = 'BUILDING', false) AND NOT coalesce(channel = 3, false)")
SEGMENT_ALL = _audience("true")
SEGMENT_BATCH = with_views(
    """SELECT 'seg_building' AS segment_id, "memberId", phone, 1 AS score
FROM user_tags WHERE sex = 'BUILDING'
UNION ALL
SELECT 'seg_heavy', "memberId", phone, 1 FROM user_tags
WHERE "orderCount" >= 15 AND NOT coalesce(phone = 'null', false)
UNION ALL
SELECT 'seg_coupon_days', "memberId", phone,
       CAST(coalesce(list_bool_or(list_transform("couponTimes",
              lambda x: x BETWEEN '2024-01-10' AND '2024-01-12')), false) AS INTEGER)
       + CAST("freeCouponTime" IS NOT NULL AS INTEGER)
FROM user_tags
WHERE coalesce(list_bool_or(list_transform("couponTimes",
              lambda x: x BETWEEN '2024-01-10' AND '2024-01-12')), false)
   OR "freeCouponTime" IS NOT NULL
UNION ALL
SELECT 'seg_not_ch3', "memberId", phone, 0 FROM user_tags WHERE NOT coalesce(channel = 3, false)
UNION ALL
SELECT 'seg_all', "memberId", phone, 0 FROM user_tags""", USER_TAGS_CTES)

# Definitions are rows of `part`; the kinds are spelt out here, the JSON texts are not used.
_DEFINED = [
    ("m < 400", """list_contains("favGoods", k)""", "1"),
    ("m >= 400 AND m < 800",
     """list_contains("favGoods", k) AND NOT coalesce(channel = k % 25, false)""", "1"),
    ("m >= 800 AND m < 995", """"orderMoney" BETWEEN k % 2000 * 1000 AND k % 2000 * 1000 + 500""", "1"),
    ("m = 995", """(in_days OR coalesce("orderCount" = k % 30, false))
       AND NOT coalesce(sex = 'BUILDING', false)""",
     """in_days::INT + coalesce("orderCount" = k % 30, false)::INT"""),
    ("m = 996", """"chargeMoney" >= 1000 OR "overTime" <= 1000000""",
     """coalesce("chargeMoney" >= 1000, false)::INT + coalesce("overTime" <= 1000000, false)::INT"""),
    ("m = 997", """"freeCouponTime" IS NOT NULL AND NOT coalesce(sex = 'MACHINERY', false)""", "1"),
    ("m = 998", "NOT coalesce(channel = 3, false) AND NOT coalesce(sex = 'BUILDING', false)", "0"),
]
_IN_DAYS = """coalesce(list_bool_or(list_transform("couponTimes", lambda x:
         x BETWEEN CAST(DATE '2024-01-01' + CAST(k % 28 AS INTEGER) AS VARCHAR)
         AND CAST(DATE '2024-01-02' + CAST(k % 28 AS INTEGER) AS VARCHAR))), false)"""
SEGMENT_FROM_TABLE = with_views(" UNION ALL ".join(
    f"""SELECT 'part-' || k AS segment_id, "memberId", phone, CAST({score} AS INTEGER) AS score
FROM (SELECT *, {_IN_DAYS if 'in_days' in where else 'NULL'} AS in_days
      FROM (SELECT p_partkey AS k, p_partkey % 1000 AS m FROM part) d
      JOIN user_tags ON {which}) x
WHERE {where}""" for which, where, score in _DEFINED), USER_TAGS_CTES)
SEGMENT_PAGE = with_views(
    f"""SELECT "memberId", phone, CAST((sex = 'BUILDING')::INT
       + coalesce("orderCount" BETWEEN 12 AND 14, false)::INT
       + coalesce(list_contains("favGoods", 7), false)::INT
       + coalesce("chargeMoney" >= 1000, false)::INT + coalesce("overTime" <= 1000000, false)::INT
       + ("feedBack" IS NOT NULL)::INT AS INTEGER) AS score
FROM user_tags WHERE {_SEGMENT_SELECT_WHERE}
ORDER BY score DESC, "memberId", phone LIMIT {P.PAGE_SIZE} OFFSET {(P.PAGE - 1) * P.PAGE_SIZE}""",
    USER_TAGS_CTES)

# ------------------------------------------------------------------------------ dates
_DUCK_TOKENS = [("yyyy", "%Y", r"\d{4}"), ("MM", "%m", r"\d{2}"), ("dd", "%d", r"\d{2}"),
                ("HH", "%H", r"\d{2}"), ("mm", "%M", r"\d{2}"), ("ss", "%S", r"\d{2}")]


def _duck_format(pattern: str) -> tuple[str, str]:
    """(strftime format, full-match regex) for a date style, token by token."""
    fmt, rx, i = "", "", 0
    while i < len(pattern):
        for tok, f, r in _DUCK_TOKENS:
            if pattern.startswith(tok, i):
                fmt, rx, i = fmt + f, rx + r, i + len(tok)
                break
        else:
            fmt, rx, i = fmt + pattern[i], rx + re.escape(pattern[i]), i + 1
    return fmt, rx


def _duck_parse(txt: str, pattern: str) -> str:
    """DuckDB parse of text in `pattern`; a missing year is 1970, a missing date 1970-01-01."""
    fmt, _ = _duck_format(pattern)
    if not pattern.startswith("yyyy") and not pattern.startswith("HH"):
        sep = pattern[2]  # '-', '/' or '月'
        lead = {"-": ("1970-", "%Y-"), "/": ("1970/", "%Y/"), "月": ("1970年", "%Y年")}[sep]
        return f"try_strptime('{lead[0]}' || {txt}, '{lead[1]}{fmt}')"
    if pattern.startswith("HH"):
        return f"try_strptime('1970-01-01 ' || {txt}, '%Y-%m-%d {fmt}')"
    return f"try_strptime({txt}, '{fmt}')"


def _style_case(txt: str) -> str:
    whens = [f"WHEN regexp_full_match({txt}, '{_duck_format(p)[1]}') THEN '{p}'"
             for p in PATTERNS]
    return "CASE " + " ".join(whens) + " END"


def _parsed_case(txt: str) -> str:
    whens = [f"WHEN regexp_full_match({txt}, '{_duck_format(p)[1]}') THEN {_duck_parse(txt, p)}"
             for p in PATTERNS]
    return "CASE " + " ".join(whens) + " END"


def _styled_events() -> str:
    whens = [f"WHEN event_id % 23 = {i} THEN strftime(ts, '{_duck_format(p)[0]}')"
             for i, p in enumerate(PATTERNS)]
    return f"SELECT event_id, CASE {' '.join(whens)} END AS txt FROM events"


_DATE_CTES = [("sd", _styled_events()),
              ("pd", f"SELECT event_id, txt, {_style_case('txt')} AS style, "
                     f"{_parsed_case('txt')} AS p FROM sd")]
_STAMP = "'%Y-%m-%d %H:%M:%S'"

DATE_NORMALIZE = with_views(
    f"""SELECT event_id, txt, style, style IS NOT NULL AS is_date,
       strftime(p, {_STAMP}) AS normalized, strftime(p, '%Y-%m-%d') AS day FROM pd""",
    _DATE_CTES)


def _date_shift(n: int) -> str:
    back = " ".join(f"WHEN style = '{p}' THEN strftime(p + INTERVAL {n} DAY, "
                    f"'{_duck_format(p)[0]}')" for p in PATTERNS)
    return with_views(
        f"""SELECT event_id, txt,
       strftime(p + INTERVAL {n} YEAR, {_STAMP}) AS plus_years,
       strftime(p + INTERVAL {n} MONTH, {_STAMP}) AS plus_months,
       strftime(p + INTERVAL {n} DAY, {_STAMP}) AS plus_days,
       strftime(p + INTERVAL {n} HOUR, {_STAMP}) AS plus_hours,
       strftime(p + INTERVAL {n} MINUTE, {_STAMP}) AS plus_minutes,
       strftime(p + INTERVAL {n} SECOND, {_STAMP}) AS plus_seconds,
       CASE {back} END AS shifted_text
FROM pd""", _DATE_CTES)


def _week_case(pos: int) -> str:
    return "CASE isodow(p) " + " ".join(f"WHEN {w[0]} THEN '{w[pos]}'" for w in WEEK) + " END"


DATE_PARTS = with_views(
    f"""SELECT event_id, txt, CAST(year(p) AS INTEGER) AS year, CAST(month(p) AS INTEGER) AS month,
       CAST(day(p) AS INTEGER) AS day, CAST(hour(p) AS INTEGER) AS hour,
       CAST(minute(p) AS INTEGER) AS minute, CAST(second(p) AS INTEGER) AS second,
       strftime(p, '%Y-%m-%d') AS date_text, strftime(p, '%H:%M:%S') AS time_text,
       CAST(isodow(p) AS INTEGER) AS weekday, {_week_case(1)} AS week_cn,
       {_week_case(2)} AS week_en, {_week_case(3)} AS week_short
FROM pd""", _DATE_CTES)


def _date_interval(as_of: dt.date) -> str:
    return with_views(
        f"""SELECT event_id, txt,
       CAST(abs(CAST(p AS DATE) - DATE '{as_of.isoformat()}') AS INTEGER) AS days FROM pd""",
        _DATE_CTES)


ORACLE_SQL: dict[str, str] = {
    "member_sex": MEMBER_SEX,
    "member_channel": MEMBER_CHANNEL,
    "member_mp_sub": MEMBER_MP_SUB,
    "member_heat": MEMBER_HEAT,
    "member_profile_json": MEMBER_PROFILE_JSON,
    "funnel_counts": FUNNEL_COUNTS,
    "repeat_buyers": REPEAT_BUYERS,
    "growth_daily": _growth_daily(P.GROWTH_AS_OF),
    "growth_calendar": _growth_calendar(P.GROWTH_AS_OF),
    "growth_daily_catalog": _growth_daily(P.GROWTH_AS_OF),
    "wow_order_catalog": _wow_compare("t_order", "order_id", P.WOW_ORDER_AS_OF),
    "growth_daily_rollup": _growth_daily(P.GROWTH_AS_OF),
    "growth_calendar_rollup": _growth_calendar(P.GROWTH_AS_OF),
    "wow_reg_daily": _wow_daily("t_member", "id", "regCount", P.WOW_REG_AS_OF),
    "wow_order_daily": _wow_daily("t_order", "order_id", "orderCount", P.WOW_ORDER_AS_OF),
    "wow_reg_compare": _wow_compare("t_member", "id", P.WOW_REG_AS_OF),
    "wow_order_compare": _wow_compare("t_order", "order_id", P.WOW_ORDER_AS_OF),
    "remind_free_daily": _remind("coupon_id = 1 AND coupon_channel = 2", "freeCount",
                                 P.REMIND_AS_OF),
    "remind_coupon_daily": _remind("coupon_id <> 1", "couponCount", P.REMIND_AS_OF),
    "hot_field_top10": HOT_FIELD_TOP10,
    "hot_field_rejects": HOT_FIELD_REJECTS,
    "hot_field_file": HOT_FIELD_FILE,
    "hot_tokens_top10": HOT_TOKENS_TOP10,
    "tag_member_base": with_views(_BASE),
    "tag_order_behavior": with_views(_ORDER_LITERAL, _ORDER_LITERAL_CTES),
    "tag_order_behavior_exact": with_views(_ORDER_EXACT, _ORDER_EXACT_CTES),
    "tag_free_coupon": with_views(_FREE),
    "tag_coupon_times": with_views(_COUPON_TIMES),
    "tag_charge_money": with_views(_CHARGE),
    "tag_over_time": with_views(_OVER_TIME),
    "tag_latest_feedback": with_views(_FEEDBACK),
    "user_tags_literal": with_views(_WIDE_SELECT, USER_TAGS_LITERAL_CTES),
    "user_tags": with_views('SELECT * FROM user_tags', USER_TAGS_CTES),
    "user_tags_incremental": with_views('SELECT * FROM user_tags', USER_TAGS_CTES),
    "segment_select": SEGMENT_SELECT,
    "segment_export": SEGMENT_EXPORT,
    "segment_export_file": SEGMENT_EXPORT,
    "segment_batch": SEGMENT_BATCH,
    "segment_exclude_only": SEGMENT_EXCLUDE_ONLY,
    "segment_all": SEGMENT_ALL,
    "segment_from_table": SEGMENT_FROM_TABLE,
    "segment_page": SEGMENT_PAGE,
    "date_normalize": DATE_NORMALIZE,
    "date_shift": _date_shift(P.DATE_SHIFT),
    "date_parts": DATE_PARTS,
    "date_interval_days": _date_interval(P.DATE_AS_OF),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
