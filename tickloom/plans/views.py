"""Temporary views over the stored tables, for use in ``spark.sql``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tickloom.operators import stats, tickers, windows
from tickloom.plans import presets


def register_bar_views(bars: DataFrame, as_of: dt.datetime | str) -> None:
    """``bars_window``, ``daily_stats``, ``hourly_stats``, ``boll1m`` and ``boll1s``."""
    windows.neighbour_bars(bars).createOrReplaceTempView("bars_window")
    stats.daily_stats(bars, as_of).createOrReplaceTempView("daily_stats")
    stats.hourly_stats(bars, as_of).createOrReplaceTempView("hourly_stats")
    presets.bollinger_1m(bars, as_of).createOrReplaceTempView("boll1m")
    presets.bollinger_1s(bars, as_of).createOrReplaceTempView("boll1s")


def register_ticker_views(ticker: DataFrame, instruments: DataFrame) -> None:
    """``symbol_usd_volume``, ``max_usd_volume``, ``last_ticker_snapshot``,
    ``symbol_volume`` and ``avg_volume_per_hour``."""
    tickers.symbol_usd_volume(ticker, instruments).createOrReplaceTempView("symbol_usd_volume")
    tickers.max_usd_volume(ticker, instruments).createOrReplaceTempView("max_usd_volume")
    tickers.last_snapshot(ticker, instruments).createOrReplaceTempView("last_ticker_snapshot")
    series = tickers.symbol_volume_series(ticker, instruments)
    series.createOrReplaceTempView("symbol_volume")
    tickers.avg_volume_by_hour(series).createOrReplaceTempView("avg_volume_per_hour")


def register_book_views(book: DataFrame, finish: dt.datetime | str | None = None) -> None:
    """``support_a`` and ``support_b``."""
    presets.support_a(book, finish).createOrReplaceTempView("support_a")
    presets.support_b(book, finish).createOrReplaceTempView("support_b")
