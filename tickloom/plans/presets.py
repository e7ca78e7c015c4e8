"""Views that fix the parameters of an operator."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tickloom.functions.times import as_utc
from tickloom.operators.book import rounded_support, support_levels, top_support
from tickloom.operators.tickers import symbol_usd_volume
from tickloom.operators.windows import signals_with_neighbours

# Parameters of the preset views.
BAND_WIDTH, BAND_BARS = 2.0, 2000
SUPPORT_A_SPLIT, SUPPORT_A_VOLUME_DIGITS = 10, 5
SUPPORT_B_SPLIT, SUPPORT_B_VOLUME_DIGITS, SUPPORT_B_TOP = 10000, 0, 20


def _bands(bars: DataFrame, period: str, start: dt.datetime) -> DataFrame:
    return signals_with_neighbours(
        bars, period=period, start=start, bandwidth=BAND_WIDTH, n=BAND_BARS
    )


def bollinger_1m(bars: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    return _bands(bars, "1m", as_utc(as_of) - dt.timedelta(days=1))


def bollinger_1s(bars: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    return _bands(bars, "1s", as_utc(as_of) - dt.timedelta(hours=3))


def support_a(book: DataFrame, finish: dt.datetime | str | None = None) -> DataFrame:
    return rounded_support(support_levels(book, SUPPORT_A_SPLIT, finish), SUPPORT_A_VOLUME_DIGITS)


def support_b(
    book: DataFrame, finish: dt.datetime | str | None = None, split_volume: int = SUPPORT_B_SPLIT
) -> DataFrame:
    rows = top_support(book, split_volume, finish, SUPPORT_B_TOP)
    return rounded_support(rows, SUPPORT_B_VOLUME_DIGITS)


def usd_volumes(ticker: DataFrame, instruments: DataFrame) -> DataFrame:
    return symbol_usd_volume(ticker, instruments)
