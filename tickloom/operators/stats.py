"""Volatility and turnover statistics, volume means."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.exact import MILLION, in_parts, rounded
from tickloom.functions.times import to_epoch_ms
from tickloom.schemas import DAY_MS, HOUR_MS, check_period


def _mean(high: Column, low: Column, rows: Column) -> Column:
    """(high * 10**6 + low) / rows, rounded; the whole part is divided apart so that it keeps all its digits."""
    scaled = (high * F.lit(MILLION).cast("decimal(7,0)")).cast("decimal(38,2)")
    rows = F.nullif(rows, F.lit(0)).cast("decimal(10,0)")
    whole = F.floor(scaled)
    rest = F.pmod(whole, rows)
    share = ((scaled - whole + rest).cast("decimal(38,12)") + low.cast("decimal(38,12)")) / rows
    return ((whole - rest) / rows).cast("decimal(38,0)") + F.round(share, 0).cast("decimal(38,0)")


def period_stats(bars: DataFrame, period: str, as_of: dt.datetime | str, duration_ms: int) -> DataFrame:
    """Per symbol over bars opened after ``as_of - duration_ms``: count, mean and
    greatest high/low spread in percent, total, mean and greatest turnover.

    A bar with low = 0 has no spread and does not count in it. Turnovers are exact
    for every volume and price that the bar table can hold, and for volumes of
    DECIMAL(32,8) while the total turnover stays below 1e30.
    """
    recent = bars.filter(
        (F.col("period") == check_period(period))
        & (F.col("open_time") > to_epoch_ms(as_of) - duration_ms)
    )
    ratio = F.try_divide(F.col("high_price"), F.col("low_price")).cast("decimal(28,16)")
    high, low = in_parts(F.col("volume"), F.col("close_price"))
    agg = recent.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("count"),
        (F.sum(ratio) / F.count(ratio)).alias("_mean"),
        F.max(ratio).alias("_max"),
        F.sum(high).alias("_high"),
        F.sum(low).alias("_low"),
        F.count(low).alias("_rows"),
        F.max(rounded(high, low)).alias("_top"),
    )
    return agg.select(
        "symbol",
        "count",
        F.round((F.col("_mean") - 1) * 100, 4).alias("avg_volatility"),
        F.round((F.col("_max") - 1) * 100, 4).alias("max_volatility"),
        rounded(F.col("_high"), F.col("_low")).alias("total_amount"),
        _mean(F.col("_high"), F.col("_low"), F.col("_rows")).alias("avg_per_day"),
        F.col("_top").alias("max_per_day"),
    )


def daily_stats(bars: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    return period_stats(bars, "1d", as_of, 30 * DAY_MS)


def hourly_stats(bars: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    return period_stats(bars, "1h", as_of, 7 * 24 * HOUR_MS)


def volume_average(bars: DataFrame, *keys: str) -> DataFrame:
    """Mean volume of a run of bars (per ``keys`` if given); 0 for an empty run."""
    mean = F.sum("volume").cast("double") / F.nullif(F.count("volume"), F.lit(0))
    return bars.groupBy(*keys).agg(F.coalesce(mean, F.lit(0.0)).alias("volume_avg"))
