"""Settings, statuses, bands and labels the results depend on."""

from datetime import date

ANALYSIS_START = date(2019, 1, 1)
SPINE_END = date(2030, 12, 31)
ACTIVE_WINDOW_DAYS = 90
LAPSING_DAYS = 365
COMPLETENESS_SETTLING_DAYS = 3
MAX_COMPLETENESS_WINDOW_DAYS = 14
VOLUME_ANOMALY_MULTIPLE = 2.0
VOLUME_ANOMALY_FLOOR = 0.35
VOLUME_BASELINE_DAYS = 28
VOLUME_WARM_UP = 50.0
FRESHNESS_WARN_HOURS = 24
FRESHNESS_ERROR_HOURS = 72
SAME_WEEKDAY_LAST_YEAR_DAYS = 364

REVENUE_STATUSES = ("Complete", "Shipped", "Processing")
ORDER_STATUSES = ("Complete", "Shipped", "Processing", "Cancelled", "Returned")
CANCELLED = "Cancelled"
RETURNED = "Returned"
GENDERS = ("M", "F")
DEPARTMENTS = ("Men", "Women")

# (exclusive upper bound, label); the last label also takes nulls
AGE_BANDS = (
    (25, "18-24"),
    (35, "25-34"),
    (45, "35-44"),
    (55, "45-54"),
    (65, "55-64"),
    (None, "65+"),
)
PRICE_TIERS = (
    (25, "Budget (<$25)"),
    (75, "Mid ($25-$75)"),
    (200, "Premium ($75-$200)"),
    (None, "Luxury ($200+)"),
)

NEVER_PURCHASED = "Never purchased"
ACTIVE_NEW = "Active - new"
ACTIVE_REPEAT = "Active - repeat"
LAPSING = "Lapsing"
CHURNED = "Churned"
CUSTOMER_STATUSES = (NEVER_PURCHASED, ACTIVE_NEW, ACTIVE_REPEAT, LAPSING, CHURNED)

# characters with the Unicode White_Space property
WHITESPACE = (
    "\t\n\u000b\u000c\r\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# a letter after one of these (or after whitespace) is capitalised in names
NAME_DELIMITERS = "[](){}/|\\<>!?@\"^#$&~_,.:;*%+-"
