"""Default parameters of the registered queries (as-of dates that give non-empty windows on the
test tables, and the audience conditions of the segment queries)."""

from __future__ import annotations

import datetime as dt

GROWTH_AS_OF = dt.date(1995, 3, 1)
WOW_REG_AS_OF = dt.date(1995, 3, 1)
WOW_ORDER_AS_OF = dt.date(1998, 1, 15)
REMIND_AS_OF = dt.date(2024, 1, 30)

SEGMENT_CONDITIONS = [
    {"name": "sex", "value": "BUILDING", "type": "match"},
    {"name": "orderCount", "lo": "12", "hi": "14", "type": "rangeBoth"},
    {"name": "favGoods", "value": "7", "type": "match"},
    {"name": "chargeMoney", "value": "1000", "type": "rangeGte"},
    {"name": "overTime", "value": "1000000", "type": "rangeLte"},
    {"name": "feedBack", "type": "exists"},
    {"name": "channel", "value": "3", "type": "notMatch"},
]

SEGMENT_EXCLUDE_ONLY = [
    {"name": "sex", "value": "BUILDING", "type": "notMatch"},
    {"name": "channel", "value": "3", "type": "notMatch"},
]

SEGMENT_BATCH = {
    "seg_building": [{"name": "sex", "value": "BUILDING", "type": "match"}],
    "seg_heavy": [{"name": "orderCount", "value": "15", "type": "rangeGte"},
                  {"name": "phone", "value": "null", "type": "notMatch"}],
    "seg_coupon_days": [{"name": "couponTimes", "lo": "2024-01-10", "hi": "2024-01-12",
                         "type": "rangeBoth"},
                        {"name": "freeCouponTime", "type": "exists"}],
    "seg_not_ch3": [{"name": "channel", "value": "3", "type": "notMatch"}],
    "seg_all": [],
}

# Date-text queries: the as-of used by the interval and the shift amount.
DATE_AS_OF = dt.date(2024, 2, 1)
DATE_SHIFT = 3

# Members on a page, and the page that the registered query returns (from 1).
PAGE_SIZE, PAGE = 50, 3

# Where the late increment of the incremental tags starts, and the partitions of a kind of state
# (a cluster takes a thousand or more).
INCREMENT_FROM = dt.date(1996, 1, 1)
COUPON_INCREMENT_FROM = dt.date(2024, 1, 15)
STATE_BUCKETS = 4
