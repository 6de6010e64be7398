"""Label expressions of the dimensions and the order status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillhouse.functions import fixed_values as fixed


def _mapped(value: Column, labels: dict[str, str], other: str) -> Column:
    chain = F
    for key, label in labels.items():
        chain = chain.when(value == key, label)
    return chain.otherwise(other)


def category_group(category: Column) -> Column:
    return _mapped(category, fixed.CATEGORY_GROUPS, fixed.OTHER_CATEGORY_GROUP)


def price_segment(price: Column) -> Column:
    chain = F
    for limit, label in fixed.PRICE_SEGMENTS:
        chain = chain.when(price <= limit, label)
    return chain.otherwise(fixed.TOP_PRICE_SEGMENT)


def promo_status(flag: Column) -> Column:
    active, inactive = fixed.PROMO_LABELS
    return F.when(flag == fixed.PROMO_ON, active).otherwise(inactive)


def region_label(tier: Column, strip_prefix: bool = False) -> Column:
    """strip_prefix also accepts tiers written like 'Tier 1'."""
    if strip_prefix:
        tier = F.regexp_replace(tier, "^Tier ", "")
    return _mapped(tier, fixed.REGION_LABELS, fixed.OTHER_REGION_LABEL)


def order_status(total: Column, calculated: Column) -> Column:
    """An order without items has no calculated total and does not count as valid."""
    return F.when(total == calculated, fixed.STATUS_VALID).otherwise(fixed.STATUS_MISMATCH)


def payment_invalid(method: Column) -> Column:
    """NULL stays NULL: a missing method is not an unknown one."""
    return ~method.isin(fixed.PAYMENT_METHODS)


def total_differs(total: Column, calculated: Column) -> Column:
    """NULL, hence not true, for an order without items."""
    return total != calculated


def price_valid(price: Column, *allowed: Column) -> Column:
    """Three-valued: NULL when the menu row is missing."""
    matches = price == allowed[0]
    for candidate in allowed[1:]:
        matches = matches | (price == candidate)
    return matches
