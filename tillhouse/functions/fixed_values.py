"""Lists, labels and limits that results must agree on."""

# Payment methods a till may record.
PAYMENT_METHODS = ["Cash", "Credit Card", "Debit Card", "GoPay", "OVO", "QRIS"]

# Order status written to the silver layer.
STATUS_VALID = "valid"
STATUS_MISMATCH = "MISMATCH TOTAL AMOUNT"

# A cashier is an outlier above mean + 3 standard deviations.
OUTLIER_DEVIATIONS = 3

# Menu category -> group; any other category is 'Lainnya'.
CATEGORY_GROUPS = {
    "Pastry": "Makanan",
    "Heavy Meal": "Makanan",
    "Coffee": "Minuman",
    "Non-Coffee": "Minuman",
}
OTHER_CATEGORY_GROUP = "Lainnya"

# Base price up to and including the limit -> segment; above the last limit 'Signature'.
PRICE_SEGMENTS = [(10000, "Value"), (17000, "Core")]
TOP_PRICE_SEGMENT = "Signature"

# Region tier -> label; any other tier is 'Unknown'.
REGION_LABELS = {"1": "Prime", "2": "Secondary", "3": "Tier 3"}
OTHER_REGION_LABEL = "Unknown"

# Promotion flag text -> status.
PROMO_ON = "true"
PROMO_LABELS = ("Active", "Inactive")

# Weekend label of a date.
WEEKEND_LABELS = ("Weekend", "Weekday")

# Default calendar range, both ends included.
CALENDAR_START = "2025-01-01"
CALENDAR_END = "2026-12-31"

# Years of the day partitions a catalog enumerates.
PROJECTED_YEARS = (2026, 2027)

# Source freshness limits in hours.
FRESHNESS_WARN_HOURS = 24
FRESHNESS_ERROR_HOURS = 48

# Text a NULL turns into in the raw layer.
NULL_TEXT = "<nil>"

# Tests of the fact's recent rows look at partitions that are not older than so many days.
RECENT_DAYS = 3
