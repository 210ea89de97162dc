"""Money in agorot (hundredths, ``bigint``) so that keys and joins are exact."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
MIN_OFFER_AGOROT = 1
MAX_MIN_QTY = 50


def to_agorot(c: Column) -> Column:
    """Price text or number to agorot, half up; null when not a number."""
    text = F.regexp_replace(F.trim(c.cast("string")), ",", "")
    return F.round(text.try_cast("decimal(24,6)") * 100, 0).cast("bigint")


def to_shekels(agorot: Column) -> Column:
    return (agorot.cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)")


def per_unit(agorot: Column, qty: Column) -> Column:
    """Price of one unit, half up to an agora."""
    return F.round(agorot.cast("decimal(18,0)") / qty.cast("decimal(10,3)"), 0).cast("bigint")


def effective_terms(min_qty: Column, agorot: Column) -> tuple[Column, Column]:
    """Quantity and unit price; a quantity below one is a weight."""
    weight = min_qty < 1
    qty = F.when(weight, F.lit(1)).otherwise(min_qty).cast("decimal(10,3)")
    unit = F.when(weight, agorot).otherwise(per_unit(agorot, qty))
    return qty, unit


def discount_tenths(unit: Column, base: Column) -> Column:
    """Discount in tenths of a percent, half up; null without a positive base."""
    share = (F.lit(2000) * (base - unit) + base).cast("double") / (F.lit(2) * base).cast("double")
    return F.when(base > 0, F.floor(share).cast("bigint"))


def offer_key(chain: Column, barcode: Column, club: Column, coupon: Column,
              min_qty: Column, agorot: Column) -> Column:
    """Stable identity of an offer: its terms, never its published id."""
    parts = [chain, barcode, club, coupon, min_qty.cast("decimal(10,3)"), agorot]
    return F.sha1(F.concat_ws("|", *[p.cast("string") for p in parts]))


def implausible(unit: Column, shelf: Column) -> Column:
    """A unit price under a fifth of a shelf price of at least five shekels."""
    return F.coalesce((shelf >= 500) & (unit * 5 < shelf), F.lit(False))
