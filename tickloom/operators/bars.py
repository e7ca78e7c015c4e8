"""Building bars: by clock, by count, and picking runs of bars."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.signals import format_price_volume
from tickloom.functions.times import start_of_period, to_epoch_ms, ts_to_ms
from tickloom.operators.blocks import DEFAULT_BLOCKS, SERIES, Blocks, first_rows, with_position
from tickloom.operators.keyed import order_key
from tickloom.schemas import (
    BARS,
    PERIOD_MONTHS,
    PERIOD_MS,
    SIGNAL_PERIOD_MINUTES,
    check_period,
)

SUMMED = (
    "volume",
    "quote_asset_volume",
    "num_trades",
    "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume",
)


def ohlc_by_clock(
    ticks: DataFrame, duration_ms: int, *, order: Sequence[str] = ("ts",), extra: Sequence[Column] = ()
) -> DataFrame:
    """Ticks (symbol, ts, price) to open/high/low/close per symbol and clock bucket.

    One shuffle of partial aggregates, so a symbol with most of the ticks costs
    no more than any other. ``order`` must be unique within a bucket.
    """
    by = order_key(order)
    return ticks.groupBy("symbol", start_of_period(F.col("ts"), duration_ms).alias("period_start")).agg(
        F.min_by("price", by).alias("open_price"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.max_by("price", by).alias("close_price"),
        *extra,
    )


def ohlc_parts(ticks: DataFrame, duration_ms: int, *, order: Sequence[str] = ("ts",)) -> DataFrame:
    """As ``ohlc_by_clock``, with the orders of the first and last tick: bars that can be merged with later parts."""
    by = F.struct(*order)
    return ticks.groupBy("symbol", start_of_period(F.col("ts"), duration_ms).alias("period_start")).agg(
        F.min_by("price", by).alias("open_price"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.max_by("price", by).alias("close_price"),
        F.min(by).alias("open_order"),
        F.max(by).alias("close_order"),
    )


def merge_ohlc(parts: DataFrame) -> DataFrame:
    """Parts of bars (``ohlc_parts``) to one per symbol and bucket: the bar of all their ticks.

    Ticks may be of any lateness and in parts of any cut; ticks that come twice change nothing.
    """
    return parts.groupBy("symbol", "period_start").agg(
        F.min_by("open_price", "open_order").alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", "close_order").alias("close_price"),
        F.min("open_order").alias("open_order"),
        F.max("close_order").alias("close_order"),
    )


def rollup_ohlc(ohlc: DataFrame, duration_ms: int) -> DataFrame:
    """Fold clock bars into longer clock bars (days into months, for instance)."""
    longer = start_of_period(F.col("period_start"), duration_ms)
    return ohlc.groupBy("symbol", longer.alias("bucket")).agg(
        F.min_by("open_price", "period_start").alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", "period_start").alias("close_price"),
    ).withColumnRenamed("bucket", "period_start")


def bars_by_clock(ticks: DataFrame, period: str, *, order: Sequence[str] = ("ts",)) -> DataFrame:
    """Ticks (symbol, ts, price, qty, taker_buy) to complete bars of a named period."""
    duration = PERIOD_MS[check_period(period)]
    amount = F.col("price") * F.col("qty")
    taker = F.col("taker_buy")
    volume = BARS["volume"].dataType
    ohlc = ohlc_by_clock(
        ticks,
        duration,
        order=order,
        extra=(
            F.sum("qty").cast(volume).alias("volume"),
            F.sum(amount).cast(volume).alias("quote_asset_volume"),
            F.count(F.lit(1)).alias("num_trades"),
            F.sum(F.when(taker, F.col("qty")).otherwise(0)).cast(volume).alias("taker_buy_base_asset_volume"),
            F.sum(F.when(taker, amount).otherwise(0)).cast(volume).alias("taker_buy_quote_asset_volume"),
        ),
    )
    opens = F.col("period_start")
    if PERIOD_MONTHS[period]:
        closes = ts_to_ms(F.add_months(opens, PERIOD_MONTHS[period]).cast("timestamp")) - 1
    else:
        closes = ts_to_ms(opens) + duration - 1
    return ohlc.withColumns(
        {"period": F.lit(period), "open_time": ts_to_ms(opens), "close_time": closes}
    ).select(*BARS.names)


def fold_bars(df: DataFrame, keys: Sequence[str], at: str, *extra: Column) -> DataFrame:
    """Fold bars per key, in the order of ``at``: first, max, min, last and sums."""
    return df.groupBy(*keys).agg(
        F.min("open_time").alias("open_time"),
        F.min_by("open_price", at).alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", at).alias("close_price"),
        F.max_by("close_time", at).alias("close_time"),
        *[F.sum(c).cast(BARS[c].dataType).alias(c) for c in SUMMED],
        *extra,
    )


def fold_positions(
    numbered: DataFrame,
    sizes: Sequence[int] = SIGNAL_PERIOD_MINUTES,
    *,
    at: str = "position",
    greatest: Sequence[str] = (),
) -> DataFrame:
    """Fold numbered minute bars into every size at once; see ``resample_by_count``.

    ``greatest`` names further columns of which a bar gets its greatest value.

    When all larger sizes are multiples of the smallest one above 1, minutes are
    first folded into that size and only the folded bars are copied per size.
    """
    sizes = sorted(set(sizes))
    kept = ["symbol", "open_time", "open_price", "high_price", "low_price", "close_price", "close_time"]
    columns = [*kept, *SUMMED, *greatest]
    extra = [F.max(c).alias(c) for c in greatest]
    minutes = numbered.select(at, *columns)
    parts = []
    if sizes[0] == 1:
        parts.append(
            minutes.select(F.lit(1).alias("size"), F.col(at).cast("bigint").alias("bar_index"), *columns)
        )
        sizes = sizes[1:]
    if sizes:
        base = sizes[0] if all(n % sizes[0] == 0 for n in sizes) else 1
        if base > 1:
            minutes = fold_bars(
                minutes.withColumn("_base", F.floor(F.col(at) / base)), ["symbol", "_base"], at, *extra
            ).withColumnRenamed("_base", at)
        copies = minutes.withColumn("size", F.explode(F.array(*[F.lit(n) for n in sizes])))
        copies = copies.withColumn("bar_index", F.floor(F.col(at) * base / F.col("size")))
        parts.append(fold_bars(copies, ["symbol", "size", "bar_index"], at, *extra).select("size", "bar_index", *columns))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("symbol", "size", "bar_index", *columns[1:])


def resample_by_count(
    minute_bars: DataFrame,
    sizes: Sequence[int] = SIGNAL_PERIOD_MINUTES,
    *,
    order: Sequence[str] = ("open_time",),
    blocks: Blocks = DEFAULT_BLOCKS,
) -> DataFrame:
    """Minute bars to N-bar bars by position, for every N in ``sizes``.

    Position, not clock: a missing minute moves all later bars. The last bar of a
    symbol may be partial. Returns ``size`` (N), the 0-based ``bar_index`` and
    the bar columns.
    """
    return fold_positions(with_position(minute_bars, order=order, blocks=blocks), sizes)


def first_n_from(bars: DataFrame, start: dt.datetime | str, n: int, *, blocks: Blocks = DEFAULT_BLOCKS) -> DataFrame:
    """The first n bars of each series at or after ``start``, with their ``row_number``; for any n by one plan."""
    return first_rows(bars.filter(F.col("open_time") >= to_epoch_ms(start)), n, blocks=blocks)


def price_vol_parts(
    bars: DataFrame, start: dt.datetime | str, n: int, *, part_rows: int = 4096, blocks: Blocks = DEFAULT_BLOCKS
) -> DataFrame:
    """``close(volume), ...`` of the first n bars from ``start`` in texts of ``part_rows`` bars, numbered from 0 by ``part``."""
    head = first_n_from(bars, start, n, blocks=blocks).select(
        *SERIES,
        F.floor((F.col("row_number") - 1) / part_rows).alias("part"),
        "row_number",
        format_price_volume(F.col("close_price"), F.col("volume")).alias("_text"),
    )
    pairs = F.array_sort(F.collect_list(F.struct("row_number", "_text")))
    text = F.array_join(F.transform(pairs, lambda p: p["_text"]), ", ")
    return head.groupBy(*SERIES, "part").agg(text.alias("price_vol_window"))


def price_vol_window(bars: DataFrame, start: dt.datetime | str, n: int, *, blocks: Blocks = DEFAULT_BLOCKS) -> DataFrame:
    """The parts of ``price_vol_parts`` as one text per series.

    Such a text lies in one row, so it is for an n that a reader would look at; longer runs are read by part.
    """
    parts = F.array_sort(F.collect_list(F.struct("part", "price_vol_window")))
    text = F.array_join(F.transform(parts, lambda p: p["price_vol_window"]), ", ")
    return price_vol_parts(bars, start, n, blocks=blocks).groupBy(*SERIES).agg(text.alias("price_vol_window"))
