"""Codes, texts, formats and lists the reports must reproduce exactly.

Everything here is data the results depend on; the logic lives in the operator modules.
"""

# Fixed values -------------------------------------------------------------------------------

# Text stored in the member table for "missing" (phone, subscription id).
NULL_TEXT = "null"

# Order status counted as a placed order.
PLACED_STATUS = 2

# Coupon id of the first-order-free coupon; channel its reminders go to; channel of charging.
FREE_COUPON_ID = 1
FREE_REMIND_CHANNEL = 2
CHARGE_CHANNEL = 1

# The first three funnel steps have no data behind them and are given numbers.
FUNNEL_TOP_STEPS = {"present": 1000, "click": 800, "addCart": 600}

# Hot words: the field taken from each tab-separated line (0-based: the third), and top N.
HOT_FIELD_INDEX = 2
HOT_FIELD_SEP = "\t"
HOT_TOP_N = 10

# Hot tokens: a token is a maximal run of non-whitespace; whitespace is space, tab, newline,
# vertical tab, form feed and carriage return.
WHITESPACE = r"[ \t\n\x0B\f\r]+"

# Audience export: line format and separator.
EXPORT_LINE = "[%s,%s]"
EXPORT_LINE_SEP = "\r\n"

# Day label format.
DAY_FORMAT = "yyyy-MM-dd"

# The 23 recognised date styles, in their natural order.
DATE_PATTERNS = [
    "MM-dd", "yyyy-MM", "yyyy-MM-dd", "MM-dd HH:mm", "MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm", "yyyy-MM-dd HH:mm:ss",
    "MM/dd", "yyyy/MM", "yyyy/MM/dd", "MM/dd HH:mm", "MM/dd HH:mm:ss",
    "yyyy/MM/dd HH:mm", "yyyy/MM/dd HH:mm:ss",
    "MM月dd日", "yyyy年MM月", "yyyy年MM月dd日", "MM月dd日 HH:mm", "MM月dd日 HH:mm:ss",
    "yyyy年MM月dd日 HH:mm", "yyyy年MM月dd日 HH:mm:ss",
    "HH:mm", "HH:mm:ss",
]

# Weekdays as (ISO number, Chinese name, English name, short English name).
WEEK = [
    (1, "星期一", "Monday", "Mon."),
    (2, "星期二", "Tuesday", "Tues."),
    (3, "星期三", "Wednesday", "Wed."),
    (4, "星期四", "Thursday", "Thur."),
    (5, "星期五", "Friday", "Fri."),
    (6, "星期六", "Saturday", "Sat."),
    (7, "星期日", "Sunday", "Sun."),
]
