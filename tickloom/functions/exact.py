"""Products of wide decimals without a cap below the column types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLION = 1_000_000


def in_parts(volume: Column, price: Column) -> tuple[Column, Column]:
    """``volume * price`` as (high, low) with high * 10**6 + low its exact value.

    The volume is cut at a million, so that either product fits 38 digits with all decimals of both.
    """
    whole = F.floor(volume / F.lit(MILLION)).cast("decimal(19,0)")
    rest = (volume - whole * F.lit(MILLION).cast("decimal(7,0)")).cast("decimal(14,8)")
    price = price.cast("decimal(18,8)")
    return whole * price, (rest * price).cast("decimal(33,16)")


def product(volume: Column, price: Column) -> Column:
    """``volume * price`` to eight digits, for any value a DECIMAL(38,8) can hold."""
    high, low = in_parts(volume, price)
    return (high * F.lit(MILLION).cast("decimal(7,0)")).cast("decimal(38,8)") + low.cast("decimal(38,8)")


def rounded(high: Column, low: Column) -> Column:
    """``high * 10**6 + low`` rounded to a whole number, halves away from zero (both parts not negative)."""
    scaled = (high * F.lit(MILLION).cast("decimal(7,0)")).cast("decimal(38,2)")
    whole = F.floor(scaled)
    return (whole + F.round((scaled - whole).cast("decimal(38,16)") + low, 0)).cast("decimal(38,0)")
