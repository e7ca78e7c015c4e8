"""Aggregations, tops and support levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom import schemas as S
from tickloom.functions.times import to_epoch_ms
from tickloom.operators import bars as bar_ops
from tickloom.operators import book as books
from tickloom.operators import keyed, stats, tickers
from tickloom.plans import presets
from tickloom.plans.fixtures import AS_OF_EVENTS, Tables, with_ctes
from tickloom.plans.queries.base import BAR_SQL, as_double, query
from tickloom.plans.queries.scalars import TEXT_SQL

OHLC_SQL = f"""SELECT symbol, make_timestamp(open_time * 1000) AS period_start,
  {as_double('open_price', 'high_price', 'low_price', 'close_price')} FROM """


@query("ohlc_by_clock", with_ctes(OHLC_SQL + "bars_1h", "bars_1h"))
def ohlc_by_clock(t: Tables):
    return bar_ops.ohlc_by_clock(t.ticks, S.HOUR_MS, order=("ts", "id"))


@query(
    "ohlc_rollup",
    with_ctes(
        """SELECT event_type AS symbol, CAST(date_trunc('month', ts) AS TIMESTAMP) AS period_start,
  CAST(CAST(arg_min(value, ts) AS DECIMAL(18,8)) AS DOUBLE) AS open_price, max(value) AS high_price,
  min(value) AS low_price, arg_max(value, ts) AS close_price
FROM events GROUP BY event_type, date_trunc('month', ts)"""
    ),
)
def ohlc_rollup(t: Tables):
    days = bar_ops.ohlc_by_clock(t.ticks, S.DAY_MS, order=("ts", "id"))
    return bar_ops.rollup_ohlc(days, 30 * S.DAY_MS)


def _stats_sql(source: str, back_ms: int) -> str:
    return with_ctes(
        f"""SELECT symbol, count(*) AS count,
  CAST(CAST((avg(ratio) - 1) * 100 AS DECIMAL(28,4)) AS DOUBLE) AS avg_volatility,
  CAST(CAST((max(ratio) - 1) * 100 AS DECIMAL(28,4)) AS DOUBLE) AS max_volatility,
  CAST(round(sum(turnover), 0) AS DOUBLE) AS total_amount,
  round(CAST(sum(turnover) AS DOUBLE) / count(*)) AS avg_per_day,
  CAST(round(max(turnover), 0) AS DOUBLE) AS max_per_day
FROM (SELECT symbol, CASE WHEN low_price <> 0 THEN CAST(high_price AS DOUBLE) / CAST(low_price AS DOUBLE) END AS ratio,
    CAST(volume AS DECIMAL(20,8)) * close_price AS turnover FROM {source}
  WHERE open_time > {to_epoch_ms(AS_OF_EVENTS) - back_ms}) GROUP BY symbol""",
        source,
    )


@query("daily_stats", _stats_sql("bars_1d", 30 * S.DAY_MS))
def daily_stats(t: Tables):
    return stats.daily_stats(t.bars("1d"), AS_OF_EVENTS)


@query("hourly_stats", _stats_sql("bars_1h", 7 * S.DAY_MS))
def hourly_stats(t: Tables):
    return stats.hourly_stats(t.bars("1h"), AS_OF_EVENTS)


MAX_USD_SQL = """SELECT symbol, CAST(round(max(usd_volume), 0) AS DOUBLE) AS max_usd_volume,
  CAST(CAST(avg(price_change_percent) AS DECIMAL(28,3)) AS DOUBLE) AS price_change
FROM usd WHERE last_price > 0 AND usd_volume IS NOT NULL GROUP BY symbol"""


@query("max_usd_volume", with_ctes(MAX_USD_SQL, "usd"))
def max_usd_volume(t: Tables):
    return tickers.max_usd_volume(t.ticker24h, t.instruments)


@query("most_popular", with_ctes(MAX_USD_SQL + " ORDER BY max_usd_volume DESC, symbol LIMIT 25", "usd"))
def most_popular(t: Tables):
    return tickers.most_popular(t.ticker24h, t.instruments, 25)


@query(
    "avg_volume_by_hour",
    with_ctes(
        """SELECT hour(ts) AS hour_of_day, round(CAST(sum(qty) AS DOUBLE) / count(*), 5) AS avg_volume
FROM ticks GROUP BY hour(ts)""",
        "ticks",
    ),
)
def avg_volume_by_hour(t: Tables):
    return tickers.avg_volume_by_hour(t.ticks.select(F.col("ts").alias("added_at"), F.col("qty").alias("volume")))


def levels_sql(split: int) -> str:
    return f"""SELECT symbol, part, CAST(sum(CAST(price AS DECIMAL(18,0)) * CAST(volume AS DECIMAL(18,8))) AS DOUBLE)
      / CAST(sum(volume) AS DOUBLE) AS price_support,
    CAST(sum(price) AS DOUBLE) / count(*) AS price_avg, CAST(min(price) AS DOUBLE) AS price_min,
    CAST(max(price) AS DOUBLE) AS price_max, CAST(sum(volume) AS DOUBLE) AS total_volume,
    count(*) AS count_prices, min(ptime) AS min_time, max(ptime) AS max_time
  FROM (SELECT *, CAST(round(sum(volume) OVER (PARTITION BY symbol ORDER BY price) / {split}) AS INTEGER) AS part
    FROM (SELECT symbol, price, arg_max(volume, ptime) AS volume, max(ptime) AS ptime
      FROM book GROUP BY symbol, price))
  WHERE volume > 0 GROUP BY symbol, part"""


@query("support_levels", with_ctes(levels_sql(500), "book"))
def support_levels(t: Tables):
    return books.support_levels(t.book, 500)


TOP_SQL = "SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY part DESC) AS rank FROM levels QUALIFY rank <= 20"


@query("top_support", with_ctes(TOP_SQL, "book", extra={"levels": levels_sql(200)}))
def top_support(t: Tables):
    return books.top_support(t.book, 200)


def _rounded_sql(source: str, digits: int) -> str:
    return f"""SELECT symbol, part, round(price_support, 2) AS support, round(price_avg, 2) AS avg, price_min AS min,
  price_max AS max, round(total_volume, {digits}) AS volume, count_prices AS count, min_time, max_time FROM {source}"""


@query(
    "preset_support_a",
    with_ctes(_rounded_sql("levels", 5), "book", extra={"levels": levels_sql(presets.SUPPORT_A_SPLIT)}),
)
def preset_support_a(t: Tables):
    return presets.support_a(t.book)


@query(
    "preset_support_b",
    with_ctes(
        _rounded_sql("top", 0),
        "book",
        extra={"levels": levels_sql(presets.SUPPORT_B_SPLIT), "top": TOP_SQL},
    ),
)
def preset_support_b(t: Tables):
    return presets.support_b(t.book)


@query(
    "volume_average",
    with_ctes(
        "SELECT symbol, period, CAST(sum(volume) AS DOUBLE) / count(*) AS volume_avg FROM bars_1h GROUP BY symbol, period",
        "bars_1h",
    ),
)
def volume_average(t: Tables):
    return stats.volume_average(t.bars("1h"), "symbol", "period")


@query(
    "latest_per_key",
    with_ctes(
        f"""SELECT {BAR_SQL} FROM bars_1h
WHERE (symbol, open_time) IN (SELECT symbol, max(open_time) FROM bars_1h GROUP BY symbol)""",
        "bars_1h",
    ),
)
def latest_per_key(t: Tables):
    return keyed.latest_per_key(t.bars("1h"), ["symbol", "period"], ["open_time"])


START, N = "2024-01-10T06:00:00", 7
HEAD_SQL = f"""SELECT *, row_number() OVER (PARTITION BY symbol, period ORDER BY open_time) AS row_number
  FROM bars_1h WHERE open_time >= {to_epoch_ms(START)} QUALIFY row_number <= {N}"""


@query(
    "price_vol_window",
    with_ctes(
        f"""SELECT symbol, period, string_agg({TEXT_SQL}, ', ' ORDER BY open_time) AS price_vol_window
FROM head GROUP BY symbol, period""",
        "bars_1h",
        extra={"head": HEAD_SQL},
    ),
)
def price_vol_window(t: Tables):
    return bar_ops.price_vol_window(t.bars("1h"), START, N)


@query(
    "first_n_from",
    with_ctes(f"SELECT {BAR_SQL}, row_number FROM head", "bars_1h", extra={"head": HEAD_SQL}),
)
def first_n_from(t: Tables):
    return bar_ops.first_n_from(t.bars("1h"), START, N)


@query(
    "latest_usd_volume",
    with_ctes(
        f"""SELECT symbol, open_time, {as_double('usd_volume')} FROM usd
WHERE (symbol_id, open_time) IN (SELECT symbol_id, max(open_time) FROM ticker24h GROUP BY symbol_id)""",
        "usd",
    ),
)
def latest_usd_volume(t: Tables):
    return tickers.latest_usd_volume(t.ticker24h, t.instruments)


@query(
    "symbol_usd_volume",
    with_ctes(
        f"""SELECT symbol, open_time, {as_double(
  'price_change_percent', 'last_price', 'volume', 'quote_volume', 'usd_volume')} FROM usd WHERE last_price > 0""",
        "usd",
    ),
)
def symbol_usd_volume(t: Tables):
    return presets.usd_volumes(t.ticker24h, t.instruments)
