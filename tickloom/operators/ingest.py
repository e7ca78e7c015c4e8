"""Bookkeeping of the bar download: page statistics, plans and cursors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.times import as_utc, to_epoch_ms, ts_to_ms
from tickloom.sources.messages import OK_STATUS, page_rows

# Rows in a full page and bars of history fetched for a new series.
PAGE_LIMIT = 1000
HISTORY_BARS = 3000


def ingest_stats(pages: DataFrame, limit: int = PAGE_LIMIT) -> DataFrame:
    """Per landed page: rows, last close time, next start, and whether it was the last.

    Computed inside each page, without a shuffle.
    """
    if "status" in pages.columns:
        pages = pages.filter(F.col("status") == OK_STATUS)
    rows = page_rows(F.col("body"))
    closes = F.transform(rows, lambda r: F.get(r, F.lit(6)).cast("bigint"))
    kept = [c for c in pages.columns if c not in ("body", "status")]
    return (
        pages.select(*kept, F.size(rows).alias("rows_affected"), F.array_max(closes).alias("last_close_time"))
        .filter("rows_affected >= 0")
        .withColumns(
            {
                "next_start": F.col("last_close_time") + 1,
                "finished": F.col("rows_affected") < limit,
            }
        )
    )


def last_bars(bars: DataFrame) -> DataFrame:
    """Open and close time of the newest bar per (symbol, period)."""
    return bars.groupBy("symbol", "period").agg(
        F.max("open_time").alias("last_open"), F.max_by("close_time", "open_time").alias("last_close")
    )


def ingest_plan(
    tracked: DataFrame,
    periods: DataFrame,
    bars: DataFrame,
    as_of: dt.datetime | str,
    *,
    default_start: dt.datetime | str | None = None,
) -> DataFrame:
    """Tracked series with the time to fetch from, and whether a fetch is due.

    A series with history starts at its last bar, which is read again; one without
    starts ``HISTORY_BARS`` periods before ``as_of``, or at ``default_start``.
    """
    now = to_epoch_ms(as_of)
    if default_start is not None:
        begin = F.lit(to_epoch_ms(default_start))
    else:
        months = F.make_ym_interval(F.lit(0), F.col("duration_months") * HISTORY_BARS)
        begin = F.when(
            F.col("duration_months") > 0, ts_to_ms(F.lit(as_utc(as_of)) - months)
        ).otherwise(F.lit(now) - F.col("duration_ms") * HISTORY_BARS)
    return (
        tracked.join(F.broadcast(periods), "period")
        .join(last_bars(bars), ["symbol", "period"], "left")
        .select(
            "symbol",
            "period",
            F.coalesce("last_open", begin).alias("start_time"),
            F.coalesce(F.col("last_close") <= now, F.lit(True)).alias("due"),
        )
    )


def default_month_start(as_of: dt.datetime | str) -> dt.datetime:
    """The start used when none is given: one calendar month before ``as_of``."""
    moment = as_utc(as_of)
    previous = moment.replace(day=1) - dt.timedelta(days=1)
    return previous.replace(day=min(moment.day, previous.day))


def ingest_cursor(watched: DataFrame, bars: DataFrame, period: str = "1m") -> DataFrame:
    """Latest open time per watched symbol (0 without history), newest first."""
    newest = bars.filter(F.col("period") == period).groupBy("symbol").agg(F.max("open_time").alias("_last"))
    return (
        watched.select("symbol")
        .join(newest, "symbol", "left")
        .select("symbol", F.coalesce("_last", F.lit(0)).alias("start_open_time"))
        .orderBy(F.desc("start_open_time"), "symbol")
    )


def history_start(cursor: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """Cursor with the start of a first download: two years before ``as_of`` instead of 0."""
    moment = as_utc(as_of)
    try:
        begin = moment.replace(year=moment.year - 2)
    except ValueError:  # 29 February
        begin = moment.replace(year=moment.year - 2, month=3, day=1)
    start = F.when(F.col("start_open_time") == 0, F.lit(to_epoch_ms(begin)))
    return cursor.withColumn("start_open_time", start.otherwise(F.col("start_open_time")))


def watched_only(rows: DataFrame, watched: DataFrame) -> DataFrame:
    """Rows of watched symbols."""
    return rows.join(watched.select("symbol"), "symbol", "left_semi")
