"""Trading-signal rules, indicator ids and text formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUY, SELL = "BUY", "SELL"

# Codes of indicators and of trade signals.
INDICATOR_NAMES = ("MAC", "MACD", "Bollinger")
SIGNAL_CODES = {None: 0, BUY: 1, SELL: 2}

# Bits of long and short term inside a packed indicator id.
LONG_TERM_BITS = 10
SHORT_TERM_BITS = 12


def trading_signal(prev: Column, last: Column, lower: Column, upper: Column) -> Column:
    """BUY when the price rises through the lower band, SELL when it falls through the upper."""
    return F.when((prev <= lower) & (last > lower), F.lit(BUY)).when(
        (prev >= upper) & (last < upper), F.lit(SELL)
    )


def crossover_signal(s1: Column, s2: Column, l1: Column, l2: Column) -> Column:
    """Short average (s1 then s2) crossing the long one (l1 then l2)."""
    valid = (s1 >= 0) & (s2 >= 0)
    return F.when((s1 < s2) & (s1 < l1) & (s2 > l2) & valid, F.lit(BUY)).when(
        (s1 > s2) & (s1 > l1) & (s2 < l2) & valid, F.lit(SELL)
    )


def signal_code(signal: Column) -> Column:
    return F.when(signal == BUY, 1).when(signal == SELL, 2).otherwise(0)


def pack_indicator_id(kind: Column, long_term: Column, short_term: Column, signal: Column) -> Column:
    """One signed 32-bit id for (indicator, long, short); negative for SELL."""
    if_valid = (
        kind.between(0, 511)
        & long_term.between(0, (1 << LONG_TERM_BITS) - 1)
        & short_term.between(0, (1 << SHORT_TERM_BITS) - 1)
    )
    packed = (kind * (1 << LONG_TERM_BITS) + long_term) * (1 << SHORT_TERM_BITS) + short_term
    checked = F.when(if_valid, packed.cast("int")).otherwise(
        F.raise_error(F.lit("indicator id out of range")).cast("int")
    )
    return F.when(signal == SELL, -checked).otherwise(checked)


def unpack_indicator_id(indicator_id: Column) -> dict[str, Column]:
    """The parts of a packed id, by name."""
    size = F.abs(indicator_id)
    return {
        "kind": F.shiftright(size, LONG_TERM_BITS + SHORT_TERM_BITS),
        "long_term": F.shiftright(size, SHORT_TERM_BITS).bitwiseAND((1 << LONG_TERM_BITS) - 1),
        "short_term": size.bitwiseAND((1 << SHORT_TERM_BITS) - 1),
        "signal": F.when(indicator_id < 0, F.lit(SELL)).otherwise(F.lit(BUY)),
    }


def indicator_name(kind: Column) -> Column:
    chain = F.when(kind == 0, F.lit(INDICATOR_NAMES[0]))
    for code, name in enumerate(INDICATOR_NAMES[1:], start=1):
        chain = chain.when(kind == code, F.lit(name))
    return chain.otherwise(F.lit(""))


def format_price_volume(close: Column, volume: Column) -> Column:
    """``close(volume)``: close without trailing zeros (the dot stays), volume rounded.

    NULL parts become empty text.
    """
    # a price always has decimals, so trailing zeros end at the dot at the latest
    price = F.rtrim(close.cast("string"), F.lit("0"))
    amount = F.round(volume, 0).cast("decimal(38,0)").cast("string")
    empty = F.lit("")
    return F.concat(F.coalesce(price, empty), F.lit("("), F.coalesce(amount, empty), F.lit(")"))


def usd_asset(asset: Column, usd_pattern: str = "%USD%") -> Column:
    return asset.like(usd_pattern)
