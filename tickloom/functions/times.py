"""Epoch, look-back and calendar helpers. The session time zone must be UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schemas import DAY_MS, PERIOD_MONTHS, PERIOD_MS, check_period

# Fixed value: fixed-width bins are counted from 2001-01-01 00:00 UTC.
BIN_ORIGIN = dt.datetime(2001, 1, 1, tzinfo=dt.timezone.utc)
_ORIGIN_MICROS = int(BIN_ORIGIN.timestamp()) * 1_000_000


def ms_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def ts_to_ms(ts: Column) -> Column:
    """Epoch ms, rounded half away from zero (``unix_millis`` would truncate)."""
    micros = F.unix_micros(ts)
    return F.call_function(
        "div", micros + F.when(micros >= 0, 500).otherwise(-500), F.lit(1000)
    )


def seconds_to_ts(ms: Column) -> Column:
    """Epoch ms to a timestamp cut to whole seconds."""
    return F.timestamp_seconds(F.call_function("div", ms, F.lit(1000)))


def as_utc(moment: dt.datetime | str) -> dt.datetime:
    """Accept ISO text or a datetime; naive values are taken as UTC."""
    if isinstance(moment, str):
        moment = dt.datetime.fromisoformat(moment)
    return moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)


def to_epoch_ms(moment: dt.datetime | str) -> int:
    delta = as_utc(moment) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return delta // dt.timedelta(milliseconds=1)


def periods_before_ms(moment: dt.datetime | str, period: str, count: int) -> int:
    """Epoch ms of ``moment - count * period``; months step through the calendar."""
    moment = as_utc(moment)
    months = PERIOD_MONTHS[check_period(period)] * count
    if not months:
        return to_epoch_ms(moment) - PERIOD_MS[period] * count
    year, month0 = divmod(moment.year * 12 + moment.month - 1 - months, 12)
    month_end = (dt.date(year + (month0 == 11), (month0 + 1) % 12 + 1, 1) - dt.timedelta(days=1)).day
    return to_epoch_ms(moment.replace(year=year, month=month0 + 1, day=min(moment.day, month_end)))


def day_ago(ts: Column) -> Column:
    return ts - F.expr("INTERVAL 1 DAY")


def week_ago(ts: Column) -> Column:
    return ts - F.expr("INTERVAL 7 DAYS")


def start_of_period(ts: Column, duration_ms: int) -> Column:
    """Start of the bucket holding ``ts``.

    A length of 1, 7 or 30 days means the calendar day, the week from Monday or
    the calendar month; any other length gives equal bins counted from 2001.
    """
    calendar = {DAY_MS: "day", 7 * DAY_MS: "week", 30 * DAY_MS: "month"}.get(duration_ms)
    if calendar:
        return F.date_trunc(calendar, ts)
    micros = F.unix_micros(ts)
    return F.timestamp_micros(
        micros - F.pmod(micros - F.lit(_ORIGIN_MICROS), F.lit(duration_ms * 1000))
    )
