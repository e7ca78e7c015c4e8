"""Operators that look at neighbouring bars of the same series."""

from __future__ import annotations

import datetime as dt

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.signals import BUY, SELL, format_price_volume, trading_signal
from tickloom.functions.times import ms_to_ts, periods_before_ms, to_epoch_ms
from tickloom.operators.blocks import (
    DEFAULT_BLOCKS,
    SERIES,
    UNBOUNDED,
    Blocks,
    split_series,
)
from tickloom.schemas import check_period, period_to_ms

LIMB = 1_000_000_000
NEIGHBOURED = ("close_price", "high_price", "low_price", "volume", "num_trades")


def _neighbours(window) -> dict[str, Column]:
    out = {}
    for name in NEIGHBOURED:
        out[f"prev_{name}"] = F.lag(name).over(window)
        out[f"next_{name}"] = F.lead(name).over(window)
    return out


def _with_spread(rows: DataFrame) -> DataFrame:
    """``_spread`` = n * (sum of squares) - (sum)^2, as a double, from the limb sums.

    The cross and low terms are added up exactly and carried into the high term, after which nothing cancels.
    """
    exact = lambda x, precision=38: f"cast({x} as decimal({precision},0))"

    def term(product: str, a: str, b: str) -> str:
        n, p, x, y = exact("_n", 10), exact(product, 27), exact(a, 18), exact(b, 18)
        return f"({exact(f'{n} * {p}')} - {exact(f'{x} * {y}')})"

    rows = rows.withColumns(
        {
            "_top": F.expr(term("_hh", "_h", "_h")),
            "_rest": F.expr(
                exact(f"{exact(term('_hl', '_h', '_l'), 28)} * {exact(2 * LIMB, 10)}") + f" + {term('_ll', '_l', '_l')}"
            ),
        }
    )
    square = f"{LIMB * LIMB}"
    rows = rows.withColumn("_low", F.expr(f"pmod({exact('_rest')}, {exact(square, 19)})"))
    carried = F.expr(f"{exact('_top')} + {exact(f'(_rest - _low) div {square}', 20)}")
    rows = rows.withColumn("_carried", carried)
    high = exact(f"{exact('_carried', 19)} * {exact(square, 19)}")
    whole = F.when(F.expr(f"_carried < {10 ** 18}"), F.expr(f"{high} + {exact('_low', 19)}").cast("double"))
    split = F.col("_carried").cast("double") * F.lit(float(LIMB * LIMB)) + F.col("_low").cast("double")
    return rows.withColumn("_spread", F.coalesce(whole, split))


def neighbour_bars(bars: DataFrame, *, blocks: Blocks = DEFAULT_BLOCKS) -> DataFrame:
    """Every bar with the previous and next value of close, high, low, volume and trades."""
    cut = split_series(bars, before=1, after=1, blocks=blocks)
    return cut.owned(cut.df.withColumns(_neighbours(cut.window)))


def bollinger_bands(
    bars: DataFrame,
    *,
    bandwidth: float = 2.0,
    n: int = 20,
    period: str | None = None,
    start: dt.datetime | str | None = None,
    neighbours: bool = False,
    blocks: Blocks = DEFAULT_BLOCKS,
) -> DataFrame:
    """Mean and population deviation of the last n closes, bands and crossing signal.

    Rows appear from the n-th bar of a series on; the first of them has no signal,
    as no earlier row was emitted. The previous close is compared with the current
    bands. With ``start`` (and the ``period`` it counts in) bars older than
    ``start - n * period`` are not read. ``neighbours`` adds the columns of
    ``neighbour_bars`` in the same pass.

    A NULL close counts as no value: mean and deviation are those of the closes
    there are, NULL without any. Sums are differences of running sums over prices
    in units of 1e-8, cut into two limbs of nine digits, so n does not change the
    cost, every price of the column type fits, and the variance is exact until it
    becomes a double.
    """
    if period is not None:
        bars = bars.filter(F.col("period") == period)
    if start is not None:
        look_back = periods_before_ms(start, check_period(period), n)
        bars = bars.filter(F.col("open_time") >= look_back)
    carried = list(NEIGHBOURED) if neighbours else ["close_price"]
    cut = split_series(
        bars.select(*SERIES, "open_time", *carried), before=n, after=int(neighbours), blocks=blocks
    )
    w = cut.window
    running = w.rowsBetween(UNBOUNDED, 0)
    added = _neighbours(w) if neighbours else {}
    units = (F.col("close_price") * F.lit(100_000_000)).cast("decimal(18,0)").cast("bigint")
    high = F.floor(units / F.lit(LIMB)).cast("decimal(10,0)")
    low = F.pmod(units, F.lit(LIMB)).cast("decimal(10,0)")
    parts = {"_h": high, "_l": low, "_hh": high * high, "_hl": high * low, "_ll": low * low}
    summed = cut.df.withColumns(
        {
            **added,
            "_at": cut.position,
            "_n": F.count("close_price").over(running),
            **{name: F.sum(part).over(running) for name, part in parts.items()},
        }
    )

    def last_n(name: str) -> Column:
        return F.col(name) - F.coalesce(F.lag(name, n).over(w), F.lit(0))

    rows = summed.withColumns(
        {
            "_n": last_n("_n"),
            **{name: last_n(name).cast("decimal(38,0)") for name in parts},
            "_prev": F.when(F.col("_at") > n - 1, F.lag("close_price").over(w)).cast("double"),
        }
    )
    rows = cut.owned(rows).filter(F.col("_at") >= n - 1)
    rows = _with_spread(rows)
    count = F.nullif(F.col("_n"), F.lit(0)).cast("double")
    total = F.expr(f"cast(_h * {LIMB} as decimal(38,0)) + cast(_l as decimal(38,0))")
    rows = rows.withColumns(
        {
            "middle_band": total.cast("double") / (count * F.lit(1e8)),
            "standard_deviation": F.sqrt(F.col("_spread") / (count * count * F.lit(1e16))),
        }
    )
    width = F.col("standard_deviation") * F.lit(float(bandwidth))
    rows = rows.withColumns(
        {"upper_band": F.col("middle_band") + width, "lower_band": F.col("middle_band") - width}
    )
    close = F.col("close_price").cast("double")
    signal = trading_signal(F.col("_prev"), close, F.col("lower_band"), F.col("upper_band"))
    bands = ["upper_band", "middle_band", "standard_deviation", "lower_band", "trade_signal"]
    return rows.withColumn("trade_signal", signal).select(
        *SERIES, "open_time", *carried, *bands, *added
    )


def signals_with_neighbours(
    bars: DataFrame,
    *,
    period: str | None = None,
    start: dt.datetime | str | None = None,
    bandwidth: float = 2.0,
    n: int = 2000,
    factor: int = 3,
    blocks: Blocks = DEFAULT_BLOCKS,
) -> DataFrame:
    """Band rows whose volume is above ``factor`` times the previous bar's volume.

    Rows without a signal stay. Bands and neighbours come from one pass over one
    sort instead of a join on open_time: from n = 2 on the neighbours of every
    band row lie inside the bars that were read. With n = 1 the join is needed.
    """
    settings = dict(bandwidth=bandwidth, n=n, period=period, start=start, blocks=blocks)
    if n > 1:
        rows = bollinger_bands(bars, neighbours=True, **settings)
    else:
        bands = bollinger_bands(bars, **settings).drop("close_price")
        rows = bands.join(neighbour_bars(bars, blocks=blocks), [*SERIES, "open_time"])
    return rows.filter(F.col("volume") > F.col("prev_volume") * factor).select(
        *SERIES,
        ms_to_ts(F.col("open_time")).alias("open_time"),
        "trade_signal",
        "volume",
        "prev_volume",
        "next_volume",
        "close_price",
        "prev_close_price",
        "next_close_price",
    )


def as_decimal(value: float | Decimal) -> Column:
    """A factor as the decimal it is written as, to six digits."""
    return F.lit(Decimal(str(value))).cast("decimal(10,6)")


def volume_spikes(
    bars: DataFrame,
    *,
    n: float | Decimal,
    as_of: dt.datetime | str | None = None,
    duration_ms: int | None = None,
    blocks: Blocks = DEFAULT_BLOCKS,
) -> DataFrame:
    """Bars whose volume is at least n times the series average and not below either
    neighbour, where the larger neighbour is above n times the average as well.

    Neighbours and average see only bars since ``as_of - duration_ms``. The text
    lists six bars from two bars earlier; it is NULL for the first two bars. The
    average is added up from the chunk table, not over a whole-series window. The
    comparison is one of decimals, so a volume at the threshold is not below it.
    """
    if as_of is not None:
        bars = bars.filter(F.col("open_time") >= to_epoch_ms(as_of) - duration_ms)
    cut = split_series(
        bars.select(*SERIES, "open_time", "close_price", "volume"),
        before=2,
        after=3,
        totals={"_sum": F.sum("volume"), "_count": F.count("volume")},
        blocks=blocks,
    )
    w = cut.window
    around = F.collect_list(format_price_volume(F.col("close_price"), F.col("volume"))).over(
        w.rowsBetween(-2, 3)
    )
    none = F.lit(0)
    marked = cut.owned(
        cut.df.withColumns(
            {
                "_prev": F.coalesce(F.lag("volume").over(w), none),
                "_next": F.coalesce(F.lead("volume").over(w), none),
                "_text": F.when(F.lag("open_time", 2).over(w).isNotNull(), F.array_join(around, ", ")),
            }
        )
    )
    level = (F.col("_sum").cast("decimal(31,8)") * as_decimal(n)).cast("decimal(38,14)")
    scaled = lambda x: (x * F.col("_count").cast("decimal(10,0)")).cast("decimal(38,14)")
    volume = F.col("volume")
    spike = (
        (scaled(volume) >= level)
        & (volume >= F.col("_prev"))
        & (volume >= F.col("_next"))
        & (scaled(F.greatest("_prev", "_next")) > level)
    )
    return marked.filter(spike).select(
        *SERIES,
        ms_to_ts(F.col("open_time")).alias("open_time"),
        F.round("volume", 0).alias("volume"),
        F.col("_text").alias("price_vol_window"),
    )


def direction_spikes(
    bars: DataFrame,
    *,
    increase: float | Decimal,
    as_of: dt.datetime | str | None = None,
    duration_ms: int | None = None,
    chunk: Column | None = None,
    blocks: Blocks = DEFAULT_BLOCKS,
) -> DataFrame:
    """Bars where the price direction changes on rising volume.

    The direction is 0 while the close moves by less than ``increase`` of itself,
    compared in decimals: a move by exactly that much counts.
    The first bar since ``as_of - duration_ms`` only initialises. The text lists
    the first seven bars from five periods earlier and may reach behind the start.
    ``chunk`` is for series that are not on their period's grid (``split_series``).
    """
    kept = [*SERIES, "open_time", "close_price", "volume"]
    look_back = F.lit(5) * period_to_ms(F.col("period"))
    start = None
    rows = bars.select(*kept)
    if as_of is not None:
        start = to_epoch_ms(as_of) - duration_ms
        rows = rows.filter(F.col("open_time") >= F.lit(start) - look_back)
    cut = split_series(rows, before=5, after=6, chunk=chunk, blocks=blocks)
    w = cut.window
    inside = F.lit(True) if start is None else F.lag("open_time").over(w) >= start
    around = F.collect_list(
        F.struct("open_time", format_price_volume(F.col("close_price"), F.col("volume")).alias("text"))
    ).over(w.rowsBetween(-5, 6))
    moved = cut.df.withColumns(
        {
            "prev_close": F.when(inside, F.lag("close_price").over(w)),
            "prev_volume": F.when(inside, F.lag("volume").over(w)),
        }
    )
    close, prev = F.col("close_price"), F.col("prev_close")
    small = F.abs(close - prev) < (close * as_decimal(increase)).cast("decimal(38,14)")
    direction = (
        F.when(prev.isNull(), F.lit(0))
        .when((close != 0) & small, F.lit(0))
        .when(close > prev, F.lit(1))
        .when(close < prev, F.lit(-1))
        .otherwise(F.lit(0))
    )
    moved = moved.withColumn("_direction", direction)
    before = F.when(F.col("prev_close").isNotNull(), F.coalesce(F.lag("_direction").over(w), F.lit(0)))
    # The lists come with the last window, so no window holds them for all rows of a block.
    moved = cut.owned(moved.withColumns({"_before": before, "_around": around}))
    turned = (F.col("_direction") != F.col("_before")) & (F.col("volume") > F.col("prev_volume"))
    signal = F.when(turned & (F.col("_direction") == 1), F.lit(BUY)).when(
        turned & (F.col("_direction") == -1), F.lit(SELL)
    )
    recent = F.filter("_around", lambda b: b["open_time"] >= F.col("open_time") - look_back)
    text = F.array_join(F.transform(F.slice(recent, 1, 7), lambda b: b["text"]), ", ")
    found = moved.withColumn("trade_signal", signal).filter(F.col("trade_signal").isNotNull())
    return found.withColumn("prices_window", text).select(
        *SERIES,
        ms_to_ts(F.col("open_time")).alias("open_time"),
        "close_price",
        "prev_close",
        "volume",
        "prev_volume",
        "trade_signal",
        "prices_window",
    )


def trailing_volume(bars: DataFrame, long_term: int, *, blocks: Blocks = DEFAULT_BLOCKS) -> DataFrame:
    """Mean volume of the last ``long_term`` and of the last three bars, this one included.

    A NULL volume counts as no value.
    """
    cut = split_series(
        bars.select(*SERIES, "open_time", "volume"), before=max(long_term, 3), blocks=blocks
    )
    w = cut.window
    summed = cut.df.withColumns(
        {
            "_count": F.count("volume").over(w.rowsBetween(UNBOUNDED, 0)),
            "_total": F.sum("volume").over(w.rowsBetween(UNBOUNDED, 0)),
        }
    )

    def mean(rows: int) -> Column:
        last = lambda name: F.col(name) - F.coalesce(F.lag(name, rows).over(w), F.lit(0))
        return F.try_divide(last("_total").cast("double"), last("_count").cast("double"))

    summed = summed.withColumns({"vol_avg": mean(long_term), "vol3_avg": mean(3)})
    return cut.owned(summed).drop("_count", "_total")


def trailing_bars(bars: DataFrame, n: int, *, blocks: Blocks = DEFAULT_BLOCKS) -> DataFrame:
    """Each bar with the array of the last n bars up to it; NULL unless its index is above n."""
    values = [c for c in bars.columns if c not in SERIES]
    cut = split_series(bars, before=n, blocks=blocks)
    last = F.collect_list(F.struct(*values)).over(cut.window.rowsBetween(-(n - 1), 0))
    return cut.owned(
        cut.df.withColumn("trailing", F.when(cut.position > n, last))
    ).select(*SERIES, "open_time", "trailing")
