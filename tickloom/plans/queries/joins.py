"""Alerts, ticker joins, ingest planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom import schemas as S
from tickloom.functions.times import to_epoch_ms
from tickloom.operators import alerts, ingest, tickers
from tickloom.plans.fixtures import AS_OF_EVENTS, Tables, with_ctes
from tickloom.plans.queries.base import BAR_SQL, as_double, query

# how far the price still has to go, downwards for kind 0 and upwards for kind 1
HIT_SQL = """SELECT * EXCLUDE (ahead) FROM (
  SELECT alerts.*, prices.price AS last_price,
    CASE kind WHEN 0 THEN prices.price - alerts.price WHEN 1 THEN alerts.price - prices.price END AS ahead
  FROM alerts JOIN prices USING (symbol) WHERE active_since IS NOT NULL)
WHERE ahead <= 0"""


@query(
    "alerts_fired",
    with_ctes(
        "SELECT user_id, symbol, CAST(last_price AS DOUBLE) AS price, kind FROM hit",
        "alerts",
        "prices",
        extra={"hit": HIT_SQL},
    ),
)
def alerts_fired(t: Tables):
    return alerts.alerts_fired(t.alerts, t.prices)


@query(
    "alerts_remaining",
    with_ctes(
        """SELECT id, user_id, symbol, price, kind, created_at, active_since FROM alerts
WHERE id NOT IN (SELECT id FROM hit)""",
        "alerts",
        "prices",
        extra={"hit": HIT_SQL},
    ),
)
def alerts_remaining(t: Tables):
    return alerts.alerts_remaining(t.alerts, alerts.alerts_hit(t.alerts, t.prices))


ARCHIVE_SQL = f"""SELECT id, user_id, symbol, price, kind, created_at, active_since,
  CAST(last_price AS DOUBLE) AS last_price, TIMESTAMP '{AS_OF_EVENTS.replace("T", " ")}' AS triggered_at FROM hit"""


@query("alerts_archived", with_ctes(ARCHIVE_SQL, "alerts", "prices", extra={"hit": HIT_SQL}))
def alerts_archived(t: Tables):
    return alerts.alerts_archived(alerts.alerts_hit(t.alerts, t.prices), AS_OF_EVENTS)


@query(
    "arm_alerts",
    with_ctes(
        f"""SELECT e.event_id AS id, e.event_type AS symbol, e.value AS price, e.event_id % 2 AS kind,
  CASE WHEN (e.event_id % 2 = 1 AND p.price < e.value) OR (e.event_id % 2 = 0 AND p.price > e.value)
    THEN TIMESTAMP '{AS_OF_EVENTS.replace("T", " ")}' END AS active_since
FROM events e LEFT JOIN prices p ON p.symbol = e.event_type AND p.symbol <> 'view'""",
        "prices",
    ),
)
def arm_alerts(t: Tables):
    requests = t.alerts.select("id", "symbol", "price", "kind")
    known = t.prices.filter(F.col("symbol") != "view")
    return alerts.arm_alerts(requests, known, AS_OF_EVENTS)


@query(
    "ticker_with_instrument",
    with_ctes(
        f"""SELECT i.symbol, t.open_time, {as_double('last_price', 'volume', 'quote_volume', table='t')}
FROM ticker24h t JOIN instruments i USING (symbol_id) WHERE t.last_price > 0""",
        "ticker24h",
        "instruments",
    ),
)
def ticker_with_instrument(t: Tables):
    rows = tickers.ticker_with_instrument(t.ticker24h, t.instruments)
    return rows.select("symbol", "open_time", "last_price", "volume", "quote_volume")


@query(
    "usd_volume",
    with_ctes(
        f"SELECT symbol, symbol_id, open_time, {as_double('usd_volume')} FROM usd", "usd"
    ),
)
def usd_volume(t: Tables):
    rows = tickers.usd_volume(t.ticker24h, t.instruments)
    return rows.select("symbol", "symbol_id", "open_time", "usd_volume")


_PERIOD_VALUES = ", ".join(f"('{n}', {ms}, {months})" for n, ms, months in S.PERIODS)
_NOW = to_epoch_ms(AS_OF_EVENTS)


@query(
    "ingest_plan",
    with_ctes(
        f"""SELECT t.symbol, t.period, coalesce(b.last_open,
    CASE WHEN p.months > 0 THEN epoch_ms(TIMESTAMP '2024-01-31' - INTERVAL 3000 MONTH)
    ELSE {_NOW} - p.ms * 3000 END) AS start_time, coalesce(b.last_close <= {_NOW}, true) AS due
FROM (SELECT DISTINCT symbol, period FROM ticks, (VALUES {_PERIOD_VALUES}) v(period, ms, months)) t
JOIN (VALUES {_PERIOD_VALUES}) p(period, ms, months) USING (period)
LEFT JOIN (SELECT symbol, period, max(open_time) AS last_open, arg_max(close_time, open_time) AS last_close
  FROM (FROM bars_1h UNION ALL FROM bars_1d) GROUP BY symbol, period) b USING (symbol, period)""",
        "bars_1h",
        "bars_1d",
    ),
)
def ingest_plan(t: Tables):
    names = F.explode(F.array(*[F.lit(n) for n, _, _ in S.PERIODS]))
    tracked = t.ticks.select("symbol").distinct().select("symbol", names.alias("period"))
    bars = t.bars("1h").unionByName(t.bars("1d"))
    return ingest.ingest_plan(tracked, S.period_dim(t.spark), bars, AS_OF_EVENTS)


@query(
    "ingest_cursor",
    with_ctes(
        """SELECT w.symbol, coalesce(max(b.open_time), 0) AS start_open_time
FROM (SELECT DISTINCT event_type AS symbol FROM events UNION SELECT DISTINCT o_orderpriority FROM orders) w
LEFT JOIN minute_bars b ON b.symbol = w.symbol GROUP BY w.symbol""",
        "minute_bars",
    ),
)
def ingest_cursor(t: Tables):
    watched = t.ticks.select("symbol").union(t.read("orders").select("o_orderpriority")).distinct()
    return ingest.ingest_cursor(watched, t.minute_bars)


@query(
    "last_snapshot",
    with_ctes(
        f"""SELECT symbol_id, symbol, open_time, make_timestamp(open_time * 1000) AS open_time_tz, close_time,
  {as_double('last_price', 'volume', 'quote_volume', 'usd_volume')}
FROM usd WHERE (symbol_id, open_time) IN (SELECT symbol_id, max(open_time) FROM ticker24h GROUP BY symbol_id)""",
        "usd",
    ),
)
def last_snapshot(t: Tables):
    rows = tickers.last_snapshot(t.ticker24h, t.instruments)
    return rows.select(
        "symbol_id",
        "symbol",
        "open_time",
        "open_time_tz",
        "close_time",
        "last_price",
        "volume",
        "quote_volume",
        "usd_volume",
    )


@query(
    "watched_only",
    with_ctes(
        f"SELECT {BAR_SQL} FROM bars_1h WHERE symbol IN (SELECT symbol FROM ticks WHERE price > 400)", "bars_1h"
    ),
)
def watched_only(t: Tables):
    watched = t.ticks.filter(F.col("price") > 400).select("symbol").distinct()
    return ingest.watched_only(t.bars("1h"), watched)
